"""Word lists, labels and phrase families. All of them are fixed values: results depend on them."""

from __future__ import annotations

# --- fixed values: word lists -------------------------------------------------

STOP_WORDS = tuple(
    "the a an and or but of to in on at for with by from as is are was were be been being "
    "it its this that these those he she they them his her their we you i not no so if "
    "then than there here what which who whom whose when where why how all any both each "
    "few more most other some such only own same too very can will just don should now "
    "has have had do does did into out up down over under again once".split()
)
FUNCTION_WORDS = tuple(
    dict.fromkeys(
        (
            "the of and to a in that it is was he his she her they i we you not "
            "with as for on at but had have be this from or an which were by so one all "
            "no there their if out up about who me him them my into over then than when "
            "what how said says would could will can did do been its our your has are am "
            "her hers himself herself itself myself don't can't didn't it's he's she's "
            "i'm they're we're you're that's there's what's very just now here where why "
            "again more most some such only own same too also because while during before "
            "after above below between through both each few other any nor until off down "
            "does doesn't didn't won't wouldn't couldn't shouldn't wasn't weren't"
        ).split()
    )
)
#: Typographic marks that say nothing about the language.
TYPOGRAPHIC = "‘’“”–—…"

# --- fixed values: labels and the keywords that stand for them ------------------

WORLDS = {
    "Contemporary": ("contemporary", "modern day", "real world", "present day", "realistic"),
    "Fantasy & Supernatural": ("fantasy", "fairy tale", "folklore", "magical realism", "paranormal", "supernatural", "magic"),
    "Science Fiction": ("science fiction", "sci-fi", "scifi", "cyberpunk", "post-apocalyptic", "post apocalyptic", "dystopian", "space", "futuristic"),
    "Historical & Western": ("historical", "western", "wild west", "period", "medieval", "victorian", "ancient"),
}
ENERGIES = {
    "External": ("external", "danger", "crime", "survival", "mission", "thrill"),
    "Relational": ("relational", "relationship", "love", "family", "inner", "everyday", "personal"),
}
TAGS = {
    "Drama / Slice of Life": ("drama", "slice of life", "slice-of-life", "literary", "coming-of-age", "everyday", "character study", "comedy"),
    "Romance": ("romance", "romantic", "love story"),
    "Mystery & Crime": ("mystery", "noir", "crime", "thriller", "detective", "heist", "suspense", "investigation"),
    "Action & Adventure": ("action", "adventure", "quest"),
    "Horror": ("horror", "slasher", "menace", "terror"),
}
NONE_WORDS = ("none", "n/a", "na", "-", "null", "unknown")
VERDICTS = ("pass", "style", "failed", "dupe", "exhausted")
DECISIONS = ("PASS", "CONDITIONAL PASS", "FAIL")

# --- fixed values: phrase families counted per 1,000 words ----------------------

CLICHE = (
    r"\bstood sentinel\b",
    r"\bheart (pounded|raced|hammered|thudded) in (her|his|my|their) chest\b",
    r"\bbreath (he|she|they|I) didn't know (he|she|they|I) was holding\b",
    r"\blet out a breath\b",
    r"\bchill ran down\b",
    r"\bshivers? ran down\b",
    r"\bsilence was deafening\b",
    r"\blittle did (he|she|they|I)\b",
    r"\btime (seemed to stand still|stood still)\b",
    r"\beyes met across\b",
    r"\bsun dipped below the horizon\b",
    r"\bnever be the same\b",
    r"\blong shadows across\b",
    r"\brain fell softly\b",
    r"\btwinkled like stars\b",
    r"\bwind whisper(ed|ing)\b",
    r"\bfull of promise\b",
    r"\ba testament to\b",
    r"\bthe air was thick with\b",
    r"\bhung (heavy|thick) in the air\b",
    r"\bdanced (in|on|through) the\b",
    r"\bpalpable\b",
)
UNCANNY = (
    r"\bsomething (shifted|stirred|watched|hung|crackled)\b",
    r"\bthe air (hummed|crackled|buzzed|shimmered|thickened|tasted)\b",
    r"\bas if the (world|universe|house|room|forest) itself\b",
    r"\breality (bent|frayed|thinned|warped|blurred)\b",
    r"\bunnerv(ing|ed)\b",
    r"\bwrongness\b",
    r"\bprickl(e|ed|ing)\b",
    r"\bwatched (her|him|them) from\b",
    r"\btoo (quiet|still|perfect)\b",
    r"\bhummed with\b",
    r"\b(silence|stillness) pressed\b",
)

"""SQL equivalents of the queries, for DuckDB over the same tables.

DuckDB's patterns (RE2) cannot look around. The one speech pattern that does is
put as two tests here, and the strip is stated by its outcome: the queries put
known wrappers before documents, so what the strip must leave is the tidied
document. A document that holds anything else to cut makes the rows differ.
"""

from __future__ import annotations

from prosemill.functions import patterns as P
from prosemill.functions.vocab import CLICHE, ENERGIES, FUNCTION_WORDS, NONE_WORDS, STOP_WORDS, TAGS, UNCANNY, WORLDS

#: What queries put before documents, by id modulo the number of entries.
WRAPS = ("**The Long Road**\nBy A. Writer\n\n", "Title: The Long Road\nGenre: Drama\n\n", "Chapter 1: The Road\n", "")
SPEECH = "The story follows a man named Arlo. "
#: Besides the wraps: headings for every round of the strip, then speech that they shield from it, and an echo.
FRONTS = (*WRAPS, "# Line\n" * 5 + SPEECH, "A light story in English.\n\n")
#: Cuts of the strip for each front, and those of echo shape.
CUTS, ECHOES = (1, 2, 1, 0, 5, 1), (0, 0, 0, 0, 0, 1)

_WS = r"[\t-\r\x1c-\x1f \x{85}\p{Z}]"
_TERMINAL = """[.!?…]["'')\\]]?\\z"""

#: Replies of queries: separators, marks around values, and for each slot its names and values.
REPLY_JOINS, REPLY_MARKS = (": ", " - ", ":", ":  "), ("", "**", '"', "'", "* ")
REPLY_SLOTS = (
    (("WORLD", "world", "World"), [*WORLDS, *(f"a kind of {w} tale" for words in WORLDS.values() for w in words), "none", "N/A", "quite another"]),
    (("ENERGY", "energy"), [*ENERGIES, *(f"{w}, for the most part" for words in ENERGIES.values() for w in words), "-", "?"]),
    (("TAGS", "tags"), [*(f"{a}, {b}; {a}" for a, b in zip(TAGS, [*TAGS][1:] + [*TAGS][:1], strict=True)), *(f"some {w}" for words in TAGS.values() for w in words), "none", "n/a, null"]),
)


def _label_of(value: str, table) -> str | None:
    """What a slot's value stands for, told by plain search: a label, the longest keyword's label, none, or nothing."""
    low = value.lower().strip()
    if low in NONE_WORDS or not low:
        return "none"
    named = [label for label in table if label.lower() == low]
    held = sorted(((-len(w), i, label) for i, (label, w) in enumerate((label, w) for label, words in table.items() for w in words) if w in low))
    return named[0] if named else held[0][2] if held else None


def _parsed_sql() -> str:
    """(doc_id, world, energy, tags, ok) of the replies."""
    worlds, energies = ([_label_of(v, t) or "?" for v in slot[1]] for slot, t in zip(REPLY_SLOTS, (WORLDS, ENERGIES), strict=False))
    tags = [",".join(dict.fromkeys(t for part in v.replace(";", ",").split(",") if (t := _label_of(part, TAGS)) not in (None, "none"))) for v in REPLY_SLOTS[2][1]]

    def of(values) -> str:
        return f"({_list(values)})[doc_id % {len(values)} + 1]"

    # Without a slot of its own, what follows "no slot" on later lines names no world either; and what is thought does not count.
    world = f"CASE WHEN doc_id % 13 = 0 THEN '?' ELSE {of(worlds)} END"
    good = f"({world} IN ({', '.join(map(_q, WORLDS))}) AND {of(energies)} IN ({', '.join(map(_q, ENERGIES))}))"
    return f"(SELECT doc_id, {world} AS world, {of(energies)} AS energy, {of(tags)} AS tags, {good} AS ok FROM documents)"


def _raw_sql() -> str:
    """The replies themselves."""

    def of(values, shift: int = 0) -> str:
        return f"({_list(values)})[(doc_id + {shift}) % {len(values)} + 1]"

    slots = [f"{of(names)} || {of(REPLY_JOINS, i)} || {of(REPLY_MARKS, i)} || {of(values)} || {of(REPLY_MARKS, i)}" for i, (names, values) in enumerate(REPLY_SLOTS)]
    head = "CASE WHEN doc_id % 5 = 0 THEN '<think>WORLD: Contemporary' || chr(10) || '</think>' ELSE '' END"
    return f"{head} || CASE WHEN doc_id % 13 <> 0 THEN {slots[0]} ELSE 'no slot' END || chr(10) || {slots[1]} || chr(10) || {slots[2]}"


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _list(words) -> str:
    return "[" + ", ".join(_q(w) for w in words) + "]"


def _norm(t: str) -> str:
    return f"trim(regexp_replace({t}, '{_WS}+', ' ', 'g'))"


def _words(t: str) -> str:
    return f"regexp_extract_all(lower({t}), '[a-z0-9'']+')"


def _key(t: str) -> str:
    return f"substr(sha1({_norm(t)}), 1, 16)"


def _sentences(t: str) -> str:
    marked = f"regexp_replace(regexp_replace({t}, '([.!?]){_WS}+', '\\1' || chr(1), 'g'), '\\n+', chr(1), 'g')"
    return f"string_split({marked}, chr(1))"


def _grams(w: str, n: int, drop: int = 0) -> str:
    return f"list_transform(range(1, greatest(len({w}) - {n - 2 + drop}, 1)), lambda i: array_to_string({w}[i:i + {n - 1}], ' '))"


def _count(pattern: str, t: str, flags: str = "") -> str:
    return f"len(regexp_extract_all({t}, {_q(flags + pattern)}))"


_D = "(SELECT doc_id, lang, source, n_chars, coalesce(text, '') AS text FROM documents)"
_W = f"(SELECT doc_id, lang, source, text, {_words('text')} AS w FROM {_D} d)"
_G = f"(SELECT doc_id, lang, source, text, w, {_grams('w', 8)} AS g8, {_grams('w', 8, 1)} AS g8b, {_grams('w', 6)} AS g6 FROM {_W} t)"
_LOOP, _ECHO = "(len(list_distinct(g8b)) < len(g8b))", "(len(list_distinct(g8)) < len(g8))"
_LOOPISH = "(len(w) >= 8 AND len(list_distinct(g6))::DOUBLE / len(g6)::DOUBLE < 0.85)"
_FOREIGN = "length(regexp_replace(text, '[\\x00-\\x7f‘’“”–—…]', '', 'g'))"
_SHARE = f"(CASE WHEN len(ew) > 0 THEN len(list_filter(ew, lambda x: list_contains({_list(FUNCTION_WORDS)}, x)))::DOUBLE / len(ew)::DOUBLE END)"
_E = f"(SELECT doc_id, text, {_FOREIGN} AS f, regexp_extract_all(lower(text), '[a-z'']+') AS ew FROM {_D} d)"
_WIDE = "(f > greatest(8.0, length(text) * 0.01))"
_STEMS = f"list_transform(list_filter({_sentences('text')}, lambda s: len({_words('s')}) >= 5), lambda s: list_distinct(list_transform(list_filter({_words('s')}, lambda x: length(x) >= 3 AND NOT list_contains({_list(STOP_WORDS)}, x)), lambda x: x[1:4])))"
_S = f"(SELECT doc_id, {_STEMS} AS s FROM {_D} d)"
_COHESION = "(CASE WHEN len(s) >= 3 THEN len(list_filter(range(1, len(s)), lambda i: list_has_any(s[i], s[i + 1])))::DOUBLE / (len(s) - 1) ELSE 0.0 END)"
_FORMAT, _DEFINE = f"(?i){P.FORMAT}", f"(?i){P.DEFINE}"
_TEMPLATE, _TEMPLATE_HEAD, _SPEAKER = P.TEMPLATE_LABEL, P.TEMPLATE_HEAD, P.SPEAKER


def _outline(t: str, raw: str) -> str:
    return (
        f"({_count(P.ROMAN_HEAD, t)} >= 2 OR regexp_matches({t}, {_q(P.OUTLINE_INTRO)}) OR regexp_matches({t}, {_q(P.INSTRUCTION_BULLET)})"
        f" OR regexp_matches({t}, {_q('(?i)' + P.SHEET_HEAD)}) OR {_count(P.LETTER_BULLET, raw)} >= 2 OR {_count(P.NUMBER_BULLET, raw)} >= 2)"
    )


_AHEAD = r"(?!\s+been)"
_LOOKING = next(m for m in P.META if _AHEAD in m)
_PLAIN_META = "|".join(m for m in P.META if m is not _LOOKING)


def _opens(t: str, pattern: str) -> str:
    return f"regexp_matches({t}, {_q(rf'(?i)^\s*(?:{pattern})')})"


def _about_story(t: str) -> str:
    """Opens with speech about a story that does not narrate. The sentence ends at the first end mark, which no opening phrase holds."""
    spoken = f"({_opens(t, _PLAIN_META)} OR ({_opens(t, _LOOKING.replace(_AHEAD, ''))} AND NOT {_opens(t, _LOOKING[: _LOOKING.index(_AHEAD)] + r'\s+been')}))"
    hit = f"coalesce(nullif(regexp_extract({t}, {_q(r'^[^.!?]*[.!?]\s*')}), ''), regexp_extract({t}, {_q(rf'(?i)^\s*(?:{_PLAIN_META})')}))"
    bare = f"regexp_replace(regexp_replace({hit}, {_q('(?i)' + P.RELATIVE_CLAUSE)}, ' ', 'g'), {_q('(?i)' + P.DESCRIBING_COPULA)}, ' ', 'g')"
    inner = f"regexp_extract({hit}, {_q(rf'(?i)^\s*{P.ECHO}')}, 1)"
    telling = f"(regexp_matches({inner}, {_q('(?i)' + P.FINITE_VERB)}) OR regexp_matches({bare}, {_q('(?i)' + P.PASSIVE_TELLING)}))"
    narrates = f"(NOT {_opens(inner, P.SPECIFYING)} AND {telling})"
    return f"({spoken} AND NOT ({_opens(hit, P.ECHO)} AND (len(string_split({_norm(hit)}, ' ')) > 12 OR {narrates})))"


def _lead_speech(t: str) -> str:
    return _opens(t, P.LEAD_SPEECH)


def _tidy(t: str) -> str:
    free = f"replace(regexp_replace({t}, '\\*(?:{_WS}*\\*){{2,}}|-{{3,}}|_{{3,}}', ' ', 'g'), '*', '')"
    return f"array_to_string(list_filter(list_transform(string_split_regex({free}, '\\n{_WS}*\\n'), lambda p: {_norm('p')}), lambda p: p <> ''), chr(10) || chr(10))"


def _fronted(fronts) -> str:
    """(doc_id, source, raw, prose, text, cuts, echoes): documents behind the fronts, and what the strip makes of them; text is what is judged."""
    n = len(fronts)

    def of(values) -> str:
        return f"([{', '.join(map(str, values))}])[doc_id % {n} + 1]"

    # A blank document leaves an empty prose if a heading line was cut, and none after other wrappers.
    prose = f"CASE WHEN doc_id % {n} = 3 THEN NULL WHEN doc_id % {n} <> 4 AND {_norm('t')} = '' THEN CASE WHEN doc_id % {n} = 2 THEN '' END ELSE {_tidy(f'(CASE WHEN doc_id % {n} = 4 THEN {_q(SPEECH)} ELSE {_q("")} END || t)')} END"
    raws = "([" + ", ".join(f"replace({_q(f.replace(chr(10), chr(1)))}, chr(1), chr(10))" for f in fronts) + f"])[doc_id % {n} + 1] || t"
    return f"""(SELECT doc_id, source, raw, prose, cuts, echoes, {_norm('coalesce(prose, raw)')} AS text FROM (
      SELECT doc_id, source, {raws} AS raw, {prose} AS prose, {of(CUTS)} AS cuts, {of(ECHOES)} AS echoes FROM (SELECT doc_id, source, text AS t FROM {_D} d) d0) d1)"""


def _gated(rows: str, most: int = 240) -> str:
    """(doc_id, source, raw, text, prose, cuts, echoes, hard, soft) of rows (the same, without the gates)."""
    return f"""(
  SELECT a.doc_id, a.source, a.raw, a.text, a.prose, a.cuts, a.echoes,
    list_filter([
      CASE WHEN NOT (len(w) BETWEEN 40 AND {most}) THEN 'len' END,
      CASE WHEN {_LOOP} THEN 'loop' END,
      CASE WHEN regexp_matches(a.text, {_q(_FORMAT)}) THEN 'format' END,
      CASE WHEN about THEN 'meta' END,
      CASE WHEN regexp_matches(a.text, {_q(_DEFINE)}) THEN 'define' END,
      CASE WHEN regexp_matches(a.text, {_q(_TEMPLATE)}) OR regexp_matches(a.text, {_q(_TEMPLATE_HEAD)}) THEN 'template' END,
      CASE WHEN {_outline('a.text', 'a.raw')} THEN 'outline' END,
      CASE WHEN NOT (NOT {_WIDE} AND (f > 0 OR coalesce(share, 0.0) >= 0.15)) THEN 'english' END,
      CASE WHEN {_lead_speech('a.text')} AND NOT about THEN 'meta' END,
      CASE WHEN cohesion < 0.10 THEN 'incoherent' END,
      CASE WHEN {_count(_SPEAKER, 'a.raw')} >= 2 THEN 'screenplay' END], lambda x: x IS NOT NULL) AS hard,
    list_filter([
      CASE WHEN len(w) BETWEEN 40 AND {most} AND (len(w) < 55 OR len(w) > {most - 15}) THEN 'len-edge' END,
      CASE WHEN {_LOOPISH} THEN 'loop-ish' END,
      CASE WHEN len(w) >= 8 AND {_ECHO} THEN 'echo' END,
      CASE WHEN NOT {_WIDE} AND f > 0 THEN 'diacritics' END,
      CASE WHEN NOT {_WIDE} AND f = 0 AND share >= 0.15 AND share < 0.22 THEN 'english-low' END,
      CASE WHEN cohesion >= 0.10 AND cohesion < 0.15 THEN 'coherence-low' END], lambda x: x IS NOT NULL) AS soft
  FROM (
    SELECT n.doc_id, n.source, n.raw, n.text, n.prose, n.cuts, n.echoes, n.w, {_grams('n.w', 8)} AS g8, {_grams('n.w', 8, 1)} AS g8b, {_grams('n.w', 6)} AS g6, n.f, n.share, {_COHESION} AS cohesion, {_about_story('n.text')} AS about
    FROM (
      SELECT doc_id, source, raw, text, prose, cuts, echoes, {_words('text')} AS w, {_FOREIGN} AS f, {_SHARE} AS share, {_STEMS} AS s
      FROM (SELECT *, regexp_extract_all(lower(text), '[a-z'']+') AS ew FROM {rows} d1) d2
    ) n
  ) a
)"""


def _judged(rows: str, most: int, stop: str | None = None) -> str:
    """(doc_id, source, raw, text, prose, k, n_tok, ends, stop, gates, review, verdict) of fronted rows; stop: SQL of how a draw ended."""
    ends = f"regexp_matches(text, '{_TERMINAL}')"
    hard = "hard"
    if stop:
        hard = f"CASE WHEN {stop} <> 'stop' THEN list_append(hard, 'no-stop') WHEN len(hard) = 0 AND NOT {ends} THEN ['no-end'] ELSE hard END"
    extra = "[CASE WHEN cuts >= 2 THEN 'style-heavy' END, CASE WHEN regexp_matches(prose, '^\\p{Ll}') THEN 'lc-start' END, CASE WHEN echoes > 0 THEN 'echo-lead' END]"
    review = f"list_concat(soft, list_filter({extra}, lambda x: x IS NOT NULL))"
    shown = f"CASE WHEN {'len(h) = 0 AND ' if stop else ''}len({review}) > 0 THEN {review} END"
    return f"""(SELECT doc_id, source, raw, text, CASE WHEN len(h) = 0 THEN prose END AS prose, {_key('raw')} AS k, CAST(len({_words(_norm('raw'))}) AS BIGINT) AS n_tok, {ends} AS ends, {stop or 'NULL'} AS stop,
      CASE WHEN len(h) > 0 THEN h END AS gates, {shown} AS review, CASE WHEN len(h) > 0 THEN 'failed' WHEN prose IS NOT NULL THEN 'style' ELSE 'pass' END AS verdict
      FROM (SELECT *, {hard} AS h FROM {_gated(rows, most)} g) g1)"""


_FRONTED = _judged(_fronted(FRONTS), 240)
_ENDED = "CASE WHEN doc_id % 11 = 0 THEN 'length' ELSE 'stop' END"


def _walk(name: str, options: str, shipped: str) -> str:
    """CTE name(idx, pick, used): leaves in order each take their first passing draw whose key nobody before them has."""
    return f"""{name}(idx, pick, used) AS (
      SELECT CAST(-1 AS BIGINT) AS idx, CAST(NULL AS STRUCT(att BIGINT, k VARCHAR)) AS pick, {shipped} AS used
      UNION ALL
      SELECT idx, pick, CASE WHEN pick IS NULL THEN used ELSE list_append(used, pick.k) END FROM (
        SELECT v.idx + 1 AS idx, v.used AS used, list_filter(o.opts, lambda x: NOT list_contains(v.used, x.k))[1] AS pick
        FROM {name} v LEFT JOIN {options} o ON o.idx = v.idx + 1 WHERE v.idx < (SELECT max(idx) FROM draws)) n)"""


def _options(rows: str) -> str:
    return f"SELECT idx, list({{'att': att, 'k': k}} ORDER BY att) AS opts FROM {rows} d WHERE verdict IN ('pass', 'style') GROUP BY idx"


_BUILT = f"""WITH RECURSIVE draws AS MATERIALIZED (SELECT CAST(doc_id // 5 AS BIGINT) AS idx, CAST(doc_id % 5 AS BIGINT) AS att, * FROM {_judged(_fronted(WRAPS), 700, _ENDED)} j),
  tried AS (SELECT * FROM draws WHERE att < 4), options AS MATERIALIZED ({_options('tried')}), {_walk('walk', 'options', 'CAST([] AS VARCHAR[])')},
  chosen AS (SELECT t.idx, coalesce(w.pick.att, max(t.att)) AS last, w.pick IS NOT NULL AS ships FROM tried t JOIN walk w ON t.idx = w.idx GROUP BY t.idx, w.pick),
  corpus AS (SELECT t.idx, 'leaf ' || CAST(t.idx AS VARCHAR) AS genre, t.att, t.att + 1 AS draws, t.k, CASE WHEN c.ships THEN t.verdict ELSE 'exhausted' END AS verdict, t.n_tok, t.ends, t.prose, t.raw
    FROM tried t JOIN chosen c ON t.idx = c.idx AND t.att = c.last)"""
_PATCHED = f"""{_BUILT}, late AS (SELECT * FROM draws WHERE att = 4 AND idx IN (SELECT idx FROM corpus WHERE verdict = 'exhausted')), later AS MATERIALIZED ({_options('late')}),
  {_walk('again', 'later', "(SELECT coalesce(list(k), CAST([] AS VARCHAR[])) FROM corpus WHERE verdict IN ('pass', 'style'))")}"""
_HEADING = P.HEADING_LINE.replace("(?=[^\\n]{101,})", "[^\\n]{101,}")


def _case(value: str, options) -> str:
    return f"({_list(options)})[CAST({value} AS BIGINT) + 1]"


_VOTES = f"""(
  SELECT CAST(l.doc_id AS VARCHAR) AS k, p.pass AS pass,
    {_case('(l.doc_id * 7 + p.pass * (l.doc_id % 3) * 2) % 5', [*WORLDS, '?'])} AS world,
    {_case('(l.doc_id + p.pass * (l.doc_id % 4)) % 2', ENERGIES)} AS energy,
    [{_case('l.doc_id % 5', TAGS)}, {_case('(l.doc_id + p.pass) % 5', TAGS)}] AS tags
  FROM labels l CROSS JOIN (SELECT unnest([1, 2, 3]) AS pass) p)"""
_VALID = f"(SELECT * FROM {_VOTES} v WHERE world <> '?')"


def _vote(column: str) -> str:
    """(k, value, confidence) of one label."""
    return f"""(
      SELECT f.k,
        CASE WHEN t.options = 1 OR t.top * 2 > t.total THEN t.best ELSE f.first_value END AS value,
        CASE WHEN t.options = 1 THEN 'unanimous' WHEN t.top * 2 > t.total THEN '2-1' ELSE 'tie' END AS confidence
      FROM (SELECT k, arg_min({column}, pass) AS first_value FROM {_VALID} a GROUP BY k) f
      JOIN (SELECT k, count(*) AS options, max(n) AS top, sum(n) AS total, arg_max({column}, n) AS best
            FROM (SELECT k, {column}, count(*) AS n FROM {_VALID} b GROUP BY k, {column}) c GROUP BY k) t ON f.k = t.k)"""


def _phrases(patterns) -> str:
    return "CAST(" + " + ".join(_count(p, "bare", "(?i)") for p in patterns) + " AS BIGINT)"


_BARE = """regexp_replace(text, '["“][^"”]*["”]', ' ', 'g')"""
_TICS = f"(SELECT lang, greatest(len(w), 1) AS n, {_phrases(CLICHE)} AS cliche, {_phrases(UNCANNY)} AS uncanny FROM (SELECT lang, w, {_BARE} AS bare FROM {_W} t) b)"
_SCORES = "(SELECT doc_id AS k, CAST((doc_id * 37) % 101 AS DOUBLE) / 101.0 AS s FROM documents)"


def _round(value: str, digits: int) -> str:
    return f"CAST(round_even({value}, {digits}) AS DOUBLE)"


def _distinct(n: int) -> str:
    g = _grams("w", n)
    return f"avg(CASE WHEN len({g}) > 0 THEN len(list_distinct({g}))::DOUBLE / len({g})::DOUBLE ELSE 1.0 END)"


def _mass(first: str, second: str) -> str:
    return f"(exp(-((doc_id * {first}) % 97 + 1) / 10.0) + exp(-((doc_id * {second}) % 97 + 1) / 10.0))"


_LINES = f"(SELECT doc_id, s, i FROM (SELECT doc_id, unnest(x) AS s, unnest(range(len(x))) AS i FROM (SELECT doc_id, {_sentences('text')} AS x FROM {_D} d) e) u WHERE len({_words('s')}) >= 5)"


def _refusal(text: str, length: str, digits: bool) -> str:
    reasons = [(f"{length} < 40", "short"), (_LOOP, "loop"), (f"regexp_matches(t, {_q(_FORMAT)})", "format"), (f"doc_id % 2 = 0 AND {' + '.join(_count(p, 't', '(?i)') for p in CLICHE)} < 2", "lowtics")]
    if digits:
        reasons.append(("regexp_matches(t, '\\p{Nd}')", "digits"))
    cases = " ".join(f"WHEN {c} THEN '{r}'" for c, r in reasons)
    return f"SELECT doc_id, CASE {cases} END AS refusal FROM (SELECT doc_id, t, w, {_grams('w', 8, 1)} AS g8b FROM (SELECT doc_id, t, {_words('t')} AS w FROM (SELECT doc_id, {text} AS t FROM {_D} d) a) b) c"


_UNIT = "(SELECT vec_id, label, list_transform(e, lambda x: CASE WHEN n > 0 THEN x / n ELSE 0.0 END) AS u FROM (SELECT vec_id, label, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS n FROM (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings) a) b)"

ORACLE = {
    "gate_profile_by_lang": f"""SELECT lang, count(*) AS n_docs,
        count(*) FILTER (len(w) BETWEEN 40 AND 240) AS n_band_240, count(*) FILTER (len(w) BETWEEN 40 AND 700) AS n_band_700,
        count(*) FILTER ({_LOOP}) AS n_loop, count(*) FILTER ({_ECHO}) AS n_echo, count(*) FILTER ({_LOOPISH}) AS n_loopish,
        count(DISTINCT {_key('text')}) AS n_keys FROM {_G} g GROUP BY lang""",
    "word_counts": f"SELECT doc_id, CAST(len(w) AS BIGINT) AS n_tok FROM {_W} t",
    "content_keys": f"SELECT doc_id, {_key('text')} AS k FROM {_D} d",
    "first_n_words": f"SELECT doc_id, array_to_string((string_split({_norm('text')}, ' '))[1:110], ' ') AS head FROM {_D} d",
    "ws_normalize": f"SELECT doc_id, md5({_norm('text')}) AS norm_md5 FROM {_D} d",
    "sentence_split": f"SELECT doc_id, CAST(len(s) AS BIGINT) AS n_sentences, CAST(len(list_filter(s, lambda x: len({_words('x')}) BETWEEN 8 AND 40)) AS BIGINT) AS n_eligible FROM (SELECT doc_id, {_sentences('text')} AS s FROM {_D} d) t",
    "length_gate": f"SELECT doc_id, len(w) BETWEEN 40 AND 240 AS in_band, (len(w) BETWEEN 40 AND 240) AND (len(w) < 55 OR len(w) > 225) AS len_edge FROM {_W} t",
    "loop_gate": f"SELECT doc_id, {_LOOP} AS loop FROM {_G} g",
    "echo_flag": f"SELECT doc_id, {_ECHO} AS echo FROM {_G} g",
    "loopish_flag": f"SELECT doc_id, {_LOOPISH} AS loopish FROM {_G} g",
    "english_gate": f"SELECT doc_id, (NOT {_WIDE} AND (f > 0 OR coalesce(share, 0.0) >= 0.15)) AS english, (NOT {_WIDE} AND f > 0) AS diacritics, {_round('share', 6)} AS function_share FROM (SELECT *, {_SHARE} AS share FROM {_E} e) t",
    "cohesion": f"SELECT doc_id, {_round(_COHESION, 6)} AS cohesion FROM {_S} t",
    "stem_sets": f"SELECT doc_id, CAST(len(list_distinct(flatten(s))) AS BIGINT) AS n_stems FROM {_S} t",
    "ends_flag": f"SELECT doc_id, regexp_matches({_norm('text')}, '{_TERMINAL}') AS ends FROM {_D} d",
    "quote_strip": f"SELECT doc_id, md5({_BARE}) AS bare_md5 FROM {_D} d",
    "format_gate": f"SELECT doc_id, regexp_matches(text, {_q(_FORMAT)}) AS format FROM {_D} d",
    "define_gate": f"SELECT doc_id, regexp_matches(text, {_q(_DEFINE)}) AS define FROM {_D} d",
    "template_gate": f"SELECT doc_id, regexp_matches(text, {_q(_TEMPLATE)}) OR regexp_matches(text, {_q(_TEMPLATE_HEAD)}) AS template FROM {_D} d",
    "outline_gate": f"SELECT doc_id, {_outline(_norm('text'), 'text')} AS outline FROM {_D} d",
    "screenplay_gate": f"SELECT doc_id, {_count(_SPEAKER, 'text')} >= 2 AS screenplay FROM {_D} d",
    "meta_gate": f"SELECT doc_id, {_about_story('t')} AS about_story, {_lead_speech('t')} AS lead_speech FROM (SELECT doc_id, {_norm(f'CASE WHEN doc_id % 2 = 0 THEN {_q(SPEECH)} || text ELSE text END')} AS t FROM {_D} d) n",
    "verdicts": f"SELECT doc_id, array_to_string(gates, ',') AS gates, array_to_string(review, ',') AS review, md5(prose) AS prose_md5, verdict FROM {_FRONTED} j",
    "failure_census": f"SELECT 'stop' AS stop, gates[1] AS gate, count(*) AS count FROM {_FRONTED} j WHERE verdict = 'failed' GROUP BY gates[1] ORDER BY count DESC, gate LIMIT 6",
    "style_strip": f"SELECT doc_id, md5(prose) AS prose_md5, CAST(cuts AS BIGINT) AS cuts, CAST(echoes AS BIGINT) AS echo_cuts FROM {_fronted(FRONTS)} f",
    "restrip": f"SELECT doc_id, verdict, array_to_string(gates, ',') AS gates, array_to_string(review, ',') AS review, verdict <> 'pass' AS changed FROM {_judged(_fronted(WRAPS), 700)} j",
    "build_corpus": f"{_BUILT} SELECT idx, genre, att, draws, k, verdict, n_tok, ends FROM corpus",
    "build_rejects": f"""{_BUILT} SELECT t.idx, t.att + 1 AS att, t.k, CASE WHEN t.verdict = 'failed' THEN 'failed' ELSE 'dupe' END AS verdict, array_to_string(t.gates, ',') AS gates
        FROM tried t JOIN chosen c ON t.idx = c.idx WHERE t.att < c.last OR (t.att = c.last AND NOT c.ships)""",
    "patch_dead_leaves": f"{_PATCHED} SELECT d.idx, 'leaf ' || CAST(d.idx AS VARCHAR) AS genre, d.att AS draws, d.verdict, d.k FROM late d JOIN again a ON d.idx = a.idx WHERE a.pick IS NOT NULL",
    "corpus_yields": f"""{_BUILT} SELECT count(*) AS leaves, count(*) FILTER (verdict <> 'exhausted') AS shipped, avg(draws) AS draws_a_leaf, avg(draws) FILTER (verdict <> 'exhausted') AS draws_a_ship FROM corpus""",
    "audit_corpus": f"""{_BUILT}, seen AS (SELECT *, coalesce(prose, raw) AS surface, {_norm('coalesce(prose, raw)')} = '' AS empty FROM corpus)
        SELECT count(*) AS n_rows, count(*) FILTER (verdict IN ('pass', 'style')) AS n_usable, count(*) FILTER (NOT ends) AS n_not_ended, count(*) FILTER ((prose IS NOT NULL) <> (verdict = 'style')) AS n_style_mismatch,
        count(*) FILTER (empty) AS n_empty, CAST(0 AS BIGINT) AS n_legacy, count(*) FILTER (NOT empty AND regexp_matches(surface, {_q(_HEADING)}) AND verdict <> 'failed') AS n_residue,
        count(*) FILTER (NOT empty AND regexp_matches(surface, {_q(_HEADING)}) AND verdict = 'failed') AS n_residue_failed, count(*) FILTER (NOT empty AND NOT (n_tok BETWEEN 40 AND 700)) AS n_out_of_band,
        count(*) FILTER (NOT empty) - count(DISTINCT k) FILTER (NOT empty) AS n_repeated_keys FROM seen""",
    "prompts_and_seeds": """SELECT doc_id, CASE WHEN leaf = source THEN 'Write a story in English. Genre: ' || leaf || '.' || chr(10) || chr(10)
        ELSE 'Write a story in English. Genre: ' || source || '. Subgenre: ' || leaf || '.' || chr(10) || chr(10) END AS prompt,
        911000000 + doc_id * 10 + doc_id % 60 AS seed FROM (SELECT doc_id, source, CASE WHEN doc_id % 3 = 0 THEN source ELSE lang END AS leaf FROM documents) d""",
    "short_draw_replacement": f"SELECT doc_id AS idx, md5(CASE WHEN len(w) < 30 THEN 'again ' || text ELSE text END) AS text_md5, CASE WHEN len(w) < 30 THEN 'length' ELSE 'stop' END AS stop FROM {_W} t",
    "short_draw_requests": f"""SELECT doc_id // 5 AS idx, doc_id % 5 AS att, 'Write a story in English. Genre: parent ' || CAST(doc_id // 50 AS VARCHAR) || '. Subgenre: leaf ' || CAST(doc_id // 5 AS VARCHAR) || '.' || chr(10) || chr(10) AS prompt,
        911000000 + doc_id // 5 * 10 + doc_id % 5 + 555555 AS seed FROM {_fronted(WRAPS)} f WHERE len({_words('raw')}) < 30""",
    "first_wins_dedup": f"SELECT doc_id, k, CASE WHEN row_number() OVER (PARTITION BY k ORDER BY doc_id) > 1 THEN 'dupe' ELSE 'pass' END AS verdict FROM (SELECT doc_id, {_key('text')} AS k FROM {_D} d) t",
    "dupe_surplus": f"SELECT count(*) - count(DISTINCT {_key('text')}) AS surplus FROM {_D} d",
    "running_ships": "SELECT doc_id, CAST(coalesce(sum(quality) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS shipped_before FROM labels",
    "resume_anti": "SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)",
    "labelled_semi": "SELECT doc_id, lang FROM documents d WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)",
    "labelled_left": "SELECT d.doc_id, lang, coalesce(quality, -1) AS quality, coalesce(toxic, -1) AS toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id",
    "labelled_inner_sorted": "SELECT d.doc_id, n_chars, quality FROM documents d JOIN labels l ON d.doc_id = l.doc_id ORDER BY d.doc_id",
    "coverage_check": """SELECT count(*) AS n_keys, count(*) FILTER (q IS NOT NULL) AS n_covered, count(*) FILTER (q IS NULL) AS n_uncovered, count(*) FILTER (q = 1 AND x = 1) AS n_both,
        CAST(round_even(100.0 * count(*) FILTER (q IS NOT NULL)::DOUBLE / count(*)::DOUBLE, 2) AS DOUBLE) AS covered_pct
        FROM (SELECT d.doc_id, l.quality AS q, l.toxic AS x FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id) t""",
    "gate_merge_dry_run": """SELECT count(*) AS n_keys, count(*) FILTER (q IS NOT NULL) AS n_covered, count(*) FILTER (q IS NULL) AS n_uncovered, count(*) FILTER (q = 1 AND x = 1) AS n_both, CAST(0 AS BIGINT) AS n_repeated, count(*) FILTER (q = 1) AS n_pass
        FROM (SELECT d.doc_id, l.quality AS q, l.toxic AS x FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id) t""",
    "gate_merge": "SELECT doc_id AS k, CASE WHEN quality = 1 THEN 'PASS' ELSE 'old' END AS gate_decision, CASE WHEN quality = 1 THEN 1.0::DOUBLE END AS gate_score, CASE WHEN quality = 1 THEN 'a' END AS gate_fails FROM labels",
    "duplicate_texts": f"SELECT {_key('text')} AS k, count(*) AS count FROM {_D} d GROUP BY {_key('text')} HAVING count(*) > 1",
    "overlay_latest": "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 1 - quality ELSE quality END AS quality FROM labels",
    "source_union": "SELECT src, count(*) AS n FROM (SELECT 'documents' AS src FROM documents UNION ALL SELECT 'benchmark' AS src FROM benchmark) t GROUP BY src",
    "content_fingerprints": f"SELECT doc_id AS k FROM {_D} d WHERE doc_id % 17 = 3 OR (doc_id % 10 = 0 AND lang IS DISTINCT FROM 'en') OR text[1] = 'a'",
    "taxonomy_leaves": """SELECT n, arg_min(p, own * 1000000000 + pos) AS p FROM (
        SELECT source AS n, source AS p, 0 AS own, min(doc_id) AS pos FROM documents GROUP BY source
        UNION ALL SELECT 'lang ' || d.lang AS n, d.source AS p, 0 AS own, m.pos AS pos FROM (SELECT DISTINCT source, lang FROM documents) d JOIN (SELECT source, min(doc_id) AS pos FROM documents GROUP BY source) m ON d.source = m.source) t
        WHERE length(n) BETWEEN 3 AND 60 GROUP BY n""",
    "taxonomy_names": "SELECT DISTINCT trim(n) AS name FROM (SELECT source AS n FROM documents UNION ALL SELECT lang AS n FROM documents) t WHERE length(trim(n)) BETWEEN 3 AND 60",
    "vote_majority": f"SELECT w.k, w.value AS world, e.value AS energy, e.confidence FROM {_vote('world')} w JOIN {_vote('energy')} e ON w.k = e.k",
    "tag_quorum": f"""SELECT g.k, array_to_string(list_filter({_list(TAGS)}, lambda t: len(list_filter(g.all_tags, lambda x: x = t)) >= 2), ',') AS tags
        FROM (SELECT k, flatten(list(list_distinct(tags))) AS all_tags FROM {_VALID} v GROUP BY k) g""",
    "vote_confidence": f"SELECT confidence, count(*) AS n FROM {_vote('energy')} e GROUP BY confidence",
    "sweep_missing": f"SELECT CAST(doc_id AS VARCHAR) AS k FROM labels l WHERE NOT EXISTS (SELECT 1 FROM {_VALID} v WHERE v.k = CAST(l.doc_id AS VARCHAR))",
    "label_parse": f"SELECT doc_id, world, energy, tags, ok FROM {_parsed_sql()} p",
    "label_outcomes": f"""SELECT p.doc_id AS k, CASE WHEN p.doc_id % 6 = 0 THEN '?' WHEN p.doc_id % 11 = 0 THEN '<err no reply>' ELSE world END AS world,
        CASE WHEN p.doc_id % 6 = 0 OR p.doc_id % 11 = 0 THEN '?' ELSE energy END AS energy, CASE WHEN p.doc_id % 6 = 0 OR p.doc_id % 11 = 0 THEN '' ELSE tags END AS tags,
        md5(CASE WHEN p.doc_id % 6 = 0 THEN '<empty>' WHEN p.doc_id % 11 = 0 THEN '' ELSE {_raw_sql()} END) AS raw_md5, ok AND p.doc_id % 6 <> 0 AND p.doc_id % 11 <> 0 AS ok FROM {_parsed_sql()} p""",
    "sweep_loop": "SELECT CAST(doc_id AS VARCHAR) AS k, CASE WHEN doc_id % 7 < 5 THEN doc_id % 7 + 1 ELSE 0 END AS sweep FROM labels",
    "votes_merged": f"""SELECT CAST(d.doc_id AS VARCHAR) AS k, v.world, v.energy, v.tags FROM documents d LEFT JOIN (
        SELECT w.k, w.value AS world, e.value AS energy, array_to_string(list_filter({_list(TAGS)}, lambda t: len(list_filter(g.all_tags, lambda x: x = t)) >= 2), ',') AS tags
        FROM {_vote('world')} w JOIN {_vote('energy')} e ON w.k = e.k JOIN (SELECT k, flatten(list(list_distinct(tags))) AS all_tags FROM {_VALID} x GROUP BY k) g ON g.k = w.k) v ON v.k = CAST(d.doc_id AS VARCHAR)""",
    "retokenise": f"SELECT t.doc_id AS k, CASE WHEN l.doc_id IS NOT NULL THEN l.doc_id * 3 ELSE CAST(len(w) AS BIGINT) END AS n_tok, CAST(len(w) AS BIGINT) AS n_word FROM {_W} t LEFT JOIN labels l ON t.doc_id = l.doc_id",
    "tic_census": f"""SELECT lang, count(*) AS docs, CAST(sum(n) AS BIGINT) AS words_total, CAST(round_even(avg(n), 0) AS BIGINT) AS words_mean,
        CAST((list_sort(list(n)))[CAST(floor(count(n) / 2) AS BIGINT) + 1] AS BIGINT) AS words_median,
        {_round('1000.0::DOUBLE * sum(cliche)::DOUBLE / sum(n)::DOUBLE', 2)} AS cliche_per_1kw, {_round('1000.0::DOUBLE * sum(uncanny)::DOUBLE / sum(n)::DOUBLE', 2)} AS uncanny_per_1kw,
        count(*) FILTER (cliche + uncanny = 0) AS docs_with_zero FROM {_TICS} t GROUP BY lang""",
    "distinct_ngrams": f"SELECT lang, {_round(_distinct(2), 3)} AS distinct2, {_round(_distinct(3), 3)} AS distinct3 FROM {_W} t GROUP BY lang",
    "cross_doc_8gram_dup": f"""SELECT CAST(sum(c) AS BIGINT) AS total, count(*) AS n_distinct, {_round('100.0::DOUBLE * (sum(c) - count(*))::DOUBLE / sum(c)::DOUBLE', 2)} AS repeated_pct
        FROM (SELECT g, count(*) AS c FROM (SELECT unnest(list_distinct(g8)) AS g FROM {_G} a) b GROUP BY g) t""",
    "vocab_size": f"SELECT lang, CAST(sum(c) AS BIGINT) AS tokens, count(*) AS vocabulary FROM (SELECT lang, x, count(*) AS c FROM (SELECT lang, unnest(w) AS x FROM {_W} a) b GROUP BY lang, x) t GROUP BY lang",
    "benchmark_ngram_overlap": f"""SELECT doc_id, count(*) AS n_shared FROM (SELECT doc_id, unnest(list_distinct(g8)) AS g FROM {_G} a) d
        WHERE g IN (SELECT unnest({_grams('w', 8)}) FROM (SELECT {_words('text')} AS w FROM benchmark) b) GROUP BY doc_id""",
    "top_first_words": f"SELECT split_part(text, ' ', 1) AS word, count(*) AS count FROM {_D} d WHERE {_norm('text')} <> '' GROUP BY split_part(text, ' ', 1) ORDER BY count DESC, word LIMIT 5",
    "percentiles_by_source": "SELECT source, count(*) AS n, quantile_cont(n_chars, 0.5) AS median, quantile_cont(n_chars, 0.9) AS p90 FROM documents GROUP BY source",
    "upper_median_by_source": "SELECT source, (list_sort(list(n_chars)))[CAST(floor(count(*) / 2) AS BIGINT) + 1] AS median FROM documents GROUP BY source",
    "conversation_join": "SELECT conv_id, md5(string_agg(coalesce(text, ''), chr(10) || chr(10) ORDER BY turn)) AS text_md5 FROM conversations GROUP BY conv_id",
    "usable_tally": f"SELECT source, count(*) AS n FROM {_FRONTED} j WHERE verdict IN ('pass', 'style') GROUP BY source",
    "even_sample": """SELECT i, doc_id FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS p, count(*) OVER () AS total FROM documents) d
        JOIN (SELECT unnest(range(50)) AS i) r ON d.p = CAST(round_even(r.i * ((d.total - 1)::DOUBLE / 49), 0) AS BIGINT)""",
    "shard_modulo": "SELECT doc_id FROM documents WHERE doc_id % 4 = 1",
    "hash_shuffle_slice": "SELECT doc_id FROM (SELECT doc_id, row_number() OVER (ORDER BY md5('7:' || CAST(doc_id AS VARCHAR)), doc_id) AS n FROM documents) t WHERE n > 20 AND n <= 50",
    "sample_within_source": "SELECT doc_id, source FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY md5('7:' || CAST(doc_id AS VARCHAR)), doc_id) AS n FROM documents) t WHERE n <= 3",
    "sentence_sample": f"""SELECT doc_id, e[CAST(CAST('0x' || substr(md5('7:' || CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) % len(e) AS BIGINT) + 1] AS sentence
        FROM (SELECT doc_id, list_filter({_sentences('text')}, lambda x: len({_words('x')}) BETWEEN 8 AND 40) AS e FROM {_D} d) t WHERE len(e) > 0""",
    "stratified_folds": "SELECT quality, CAST(fold AS INTEGER) AS fold, n // 5 + CASE WHEN fold < n % 5 THEN 1 ELSE 0 END AS n FROM (SELECT quality, count(*) AS n FROM labels GROUP BY quality) t CROSS JOIN range(5) r(fold)",
    "paragraph_chunks": f"SELECT doc_id, CAST(p AS BIGINT) AS paragraph, md5(string_agg(s, ' ' ORDER BY i)) AS text_md5 FROM (SELECT doc_id, s, i, (row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1) // 5 AS p FROM {_LINES} l) t GROUP BY doc_id, p HAVING count(*) = 5",
    "held_out_openings": f"""SELECT doc_id, count(*) AS n_kept FROM {_LINES} l WHERE array_to_string(({_words('s')})[1:8], ' ') NOT IN (
        SELECT array_to_string(({_words('g')})[1:8], ' ') FROM (SELECT unnest({_sentences('text')}) AS g FROM benchmark) b) GROUP BY doc_id""",
    "paragraph_scores": f"""WITH parts AS (SELECT doc_id, {_sentences('text')} AS all_s, text FROM {_D} d),
        asked AS (SELECT doc_id, unnest(CASE WHEN len(e) > 0 THEN e ELSE [text] END) AS s FROM (SELECT doc_id, text, list_distinct(list_filter(all_s, lambda x: len({_words('x')}) BETWEEN 8 AND 40)) AS e FROM parts) p),
        known AS (SELECT DISTINCT unnest(all_s) AS s FROM parts)
        SELECT a.doc_id AS k, {_round('avg(CASE WHEN k.s IS NOT NULL THEN (length(a.s) % 10) / 10.0 END)', 6)} AS score FROM asked a LEFT JOIN known k ON a.s = k.s GROUP BY a.doc_id""",
    "positive_verification": _refusal(f"array_to_string((string_split({_norm('text')}, ' '))[1:110], ' ')", f"(CASE WHEN {_norm('t')} = '' THEN 0 ELSE len(string_split({_norm('t')}, ' ')) END)", False),
    "positive_verification_whole": _refusal("text", "len(w)", True),
    "rewrite_acceptance": f"""SELECT doc_id, (b <> '' AND b <> a AND NOT regexp_matches(b, '(?m)^#|\\*\\*|^Paragraph|^Rewritten') AND NOT contains(b, '______') AND NOT regexp_matches(b, '\\p{{Nd}}')
        AND len(wb)::DOUBLE / greatest(len(wa), 1) BETWEEN 0.6 AND 1.5 AND abs(len({_sentences('a')}) - len({_sentences('b')})) <= 1
        AND len(list_intersect(list_distinct(wa), list_distinct(wb)))::DOUBLE / greatest(len(list_distinct(list_concat(wa, wb))), 1) BETWEEN 0.15 AND 0.9) AS accepted
        FROM (SELECT doc_id, a, b, {_words('a')} AS wa, {_words('b')} AS wb FROM (SELECT doc_id, text AS a, regexp_replace(text, '\\bof the\\b|\\bthe\\b', 'a', 'g') AS b FROM {_D} d) c) t""",
    "job_grid": """WITH g AS (SELECT text, row_number() OVER (ORDER BY item_id) - 1 AS g, count(*) OVER () AS n FROM benchmark),
        jobs AS (SELECT o.o * 10 + r.r AS i, o.opener, r.r AS repeat FROM (VALUES (0, 'The town had'), (1, 'By then the village')) o(o, opener) CROSS JOIN range(10) r(r))
        SELECT j.i, j.opener, j.repeat, md5(a.text) AS first_md5, md5(b.text) AS second_md5 FROM jobs j JOIN g a ON j.i % a.n = a.g JOIN g b ON (j.i + 1) % b.n = b.g""",
    "auc_ranksum": """SELECT CAST(round_even(a, 9) AS DOUBLE) AS auc, CASE WHEN a > 0.85 THEN 'GO' ELSE 'WEAK' END AS decision FROM (
        SELECT avg(CASE WHEN x.n_chars > y.n_chars THEN 1.0 WHEN x.n_chars = y.n_chars THEN 0.5 ELSE 0.0 END) AS a
        FROM (SELECT n_chars FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE quality = 1) x
        CROSS JOIN (SELECT n_chars FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE quality = 0) y) t""",
    "spearman_probe": """SELECT CAST(round_even(corr(ra, rb), 6) AS DOUBLE) AS rho FROM (
        SELECT rank() OVER (ORDER BY a) + (count(*) OVER (PARTITION BY a) - 1) / 2.0 AS ra, rank() OVER (ORDER BY b) + (count(*) OVER (PARTITION BY b) - 1) / 2.0 AS rb
        FROM (SELECT n_chars AS a, strlen(text) AS b FROM documents WHERE text IS NOT NULL) t) r""",
    "judge_reduce": f"SELECT doc_id, {_round(f'{_mass("3", "5")} / ({_mass("3", "5")} + {_mass("7", "11")})', 6)} AS p FROM documents",
    "paired_wins": f"""SELECT count(*) AS n, {_round('avg(CASE WHEN d > 0 THEN 1.0 ELSE 0.0 END)', 6)} AS win_rate, {_round('(list_sort(list(d)))[CAST(floor(count(*) / 2) AS BIGINT) + 1]', 6)} AS median_margin,
        CASE WHEN avg(CASE WHEN d > 0 THEN 1.0 ELSE 0.0 END) > 0.85 THEN 'GO' ELSE 'STOP' END AS decision
        FROM (SELECT g.s - f.s AS d FROM {_SCORES} f JOIN {_SCORES} g ON g.k = f.k + 1 WHERE f.k % 2 = 0) t""",
    "flag_rate": f"""SELECT count(*) AS n, count(*) FILTER (score IS NULL) AS n_missing, {_round('avg(CASE WHEN score IS NULL THEN NULL WHEN score >= 0.12 THEN 1.0 ELSE 0.0 END)', 6)} AS flag_rate, {_round('avg(score)', 6)} AS mean_score
        FROM (SELECT CASE WHEN k % 9 <> 0 THEN s END AS score FROM {_SCORES} a) t""",
    "l2_normalize": f"SELECT vec_id, {_round('u[1]', 6)} AS u0, {_round('list_sum(u)', 6)} AS u_sum FROM {_UNIT} t",
    "embedding_label_mean": f"SELECT label, count(*) AS n, {_round('avg(u[1])', 6)} AS u0_mean FROM {_UNIT} t GROUP BY label",
    "classifier_input": f"SELECT doc_id, md5(substr(CASE WHEN doc_id % 3 = 1 THEN 'prose ' || text ELSE text END, 1, 8000)) AS input_md5 FROM {_D} d",
    "subword_counts": f"SELECT CAST(doc_id AS VARCHAR) AS k, CAST(CASE WHEN {_norm('text')} = '' THEN 0 ELSE len(string_split({_norm('text')}, ' ')) END AS BIGINT) AS n FROM {_D} d",
    "stream_dedup": f"SELECT DISTINCT {_key('text')} AS k FROM {_D} d",
}

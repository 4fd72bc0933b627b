from pyspark.sql import functions as F

from prosemill.functions import gates as G
from prosemill.functions import text as T
from prosemill.functions.gates import with_gates

STORY = "The keeper of the old house walked to the harbor. The harbor was calm and the keeper watched the boats. The boats came home to the harbor in the evening. Then the keeper lit the lamp of the house and the lamp burned over the water. In the night the water rose and the lamp burned on for the boats that were late."


def one(spark, column, text):
    return spark.createDataFrame([(text,)], "t string").select(column.alias("x")).first()["x"]


def test_normalise_covers_all_white_space_and_is_idempotent(spark):
    raw = "\t a b c\x1cd　 e\n"
    assert one(spark, T.normalise(F.col("t")), raw) == "a b c d e"
    assert one(spark, T.normalise(T.normalise(F.col("t"))), raw) == "a b c d e"
    assert one(spark, T.normalise(F.col("t")), "a​b") == "a​b"
    assert one(spark, T.normalise(F.col("t")), " \n ") == ""


def test_content_key_ignores_spacing_but_not_case(spark):
    key = lambda t: one(spark, T.content_key(F.col("t")), t)
    assert key("a  b\n") == key("a b") != key("A b")
    assert len(key("")) == 16


def test_sentences_and_first_words(spark):
    assert one(spark, T.sentences(F.col("t")), "One. Two!\nThree") == ["One.", "Two!", "Three"]
    assert one(spark, T.first_words(F.col("t"), 2), "  a\nb c") == "a b"


def test_ngrams_around_their_length(spark):
    for words, grams in ((0, 0), (7, 0), (8, 1), (9, 2)):
        text = " ".join(f"w{i}" for i in range(words))
        assert len(one(spark, T.ngrams(T.tokens(F.col("t")), 8), text)) == grams


def test_endings(spark):
    for text, good in (("a.", True), ('a?"', True), ("a…", True), ("a,", False), ("a", False), ("a.”", False), ("", False)):
        assert one(spark, T.ends(F.col("t")), text) is good, text


def gates(spark, text, raw=None, max_words=240):
    rows = spark.createDataFrame([(text, raw if raw is not None else text)], "text string, raw string")
    row = with_gates(rows, "text", "raw", max_words).first()
    return row["hard"], row["soft"]


def test_a_plain_story_passes(spark):
    assert gates(spark, STORY) == ([], [])


def test_null_is_an_empty_text(spark):
    assert gates(spark, None)[0] == ["len", "english", "incoherent"]


def test_word_band_and_its_edges(spark):
    for n, hard, edge in ((39, True, False), (40, False, True), (54, False, True), (55, False, False), (225, False, False), (226, False, True), (240, False, True), (241, True, False)):
        found = gates(spark, " ".join(f"w{i}" for i in range(n)))
        assert ("len" in found[0], "len-edge" in found[1]) == (hard, edge), n


def test_loop_leaves_out_the_last_gram_and_echo_does_not(spark):
    eight = "one two three four five six seven eight"
    middle = " ".join(f"m{i}" for i in range(30))
    assert "loop" not in gates(spark, f"{eight} {middle} {eight}")[0]
    assert "echo" in gates(spark, f"{eight} {middle} {eight}")[1]
    assert "loop" in gates(spark, f"{eight} {middle} {eight} end")[0]


def test_language(spark):
    assert "english" not in gates(spark, STORY + " Café.")[0]
    assert "diacritics" in gates(spark, STORY + " Café.")[1]
    assert "diacritics" not in gates(spark, STORY + " “Well—”")[1]
    assert "english" in gates(spark, STORY + " " + "é" * 9)[0]
    assert "english" in gates(spark, "satu dua tiga empat lima enam " * 10)[0]
    assert "english" in gates(spark, "12 34 56 " * 20)[0]


def test_cohesion(spark):
    share = lambda t: one(spark, G.cohesion(G.sentence_stems(F.col("t"))), t)
    assert share("The red house stood alone there. The red house fell down today.") == 0.0
    chained = "The red house stood alone there. A house burned down last winter. Last winter snow covered every road."
    assert share(chained) == 1.0
    assert share("Rivers carry silt toward deltas. Clocks chime twelve every noon. Bakers knead dough before dawn.") == 0.0


def test_speech_about_the_story(spark):
    about = lambda t: one(spark, G.about_story(F.col("t")), t)
    assert about("The story follows a man. He ran.")
    assert about("A light and fluffy story in English. He ran.")
    assert about("A tale of woe that was told by sailors.")
    assert not about("A tale of woe told by sailors.")
    assert not about("A story of a boy " + "and a dog " * 6 + "ran on.")
    assert not about("He told the story of a man.")
    assert one(spark, G.lead_speech(F.col("t")), "As an AI I cannot do that. He ran.")


def test_speech_gates_keep_the_order_of_evaluation(spark):
    assert gates(spark, "As an AI I cannot. " + STORY)[0] == ["meta"]
    assert gates(spark, "I decided to write é. " + "é" * 12 + STORY)[0] == ["english", "meta"]


def test_other_gates(spark):
    hit = lambda text, raw=None: set(gates(spark, text, raw)[0])
    assert "format" in hit(STORY + " answer: yes")
    assert "define" in hit(STORY + " It is a unique type of work.")
    assert "template" in hit(STORY + " Setting: a house")
    assert "template" not in hit(STORY + " Update: a house")
    assert "template" in hit("Chapter 2: The House " + STORY)
    assert "template" not in hit("Chapter 2 covered the war. " + STORY)
    assert "outline" in hit(f"I. {STORY} II. {STORY}"[:900])
    assert "outline" not in hit(f"I. {STORY}")
    assert "outline" in hit(STORY, f"1. a\n2. b\n{STORY}")
    assert "outline" not in hit(STORY, f"1. a\n{STORY}")
    assert "screenplay" in hit(STORY, 'Anna: "Go."\nBen: (sits)\n' + STORY)
    assert "screenplay" not in hit(STORY, 'Anna: "Go."\n' + STORY)

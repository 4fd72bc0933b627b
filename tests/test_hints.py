import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from prosemill.functions import hints as H
from prosemill.functions import patterns as P
from prosemill.functions.strip import stripped, strip_wrappers
from prosemill.plans import catalog

PARTS = ["Given the context", "possible answers", "Answer:", "question:", "Step 3", "note:", "Here is ", "here are ", "is a unique type of", "should be a narrative in which", "is a type of story", "Setting", "Plot Summary", "Characters", "Synopsis", ": x", "I. ", "IV. ", "VIII. ", "V.", "A. Set up", "E.  Give an", "C. Establish", "a. *Title", "A.Plot", "Chapter 2", "part IV", "ſcene one", "Epılogue", " ", "\n", "# ", ". ", "x"]
TALK = ["The story is", "this story", "I'm", "I have to write a", "Here's a story", "A", "The", " tale of", "It should have", "You must write", "Each page", "not limited to any specific", "Use vivid", "Let's create a story", "ſ", "In this story", " ", "x"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=6).map("".join))
def test_no_pattern_matches_without_its_hint(text):
    text = " ".join(text.split())
    bits = H.hints(text)
    found = {
        "format": re.search(P.FORMAT, text, re.I),
        "define": re.search(P.DEFINE, text, re.I),
        "label": re.search(P.TEMPLATE_LABEL, text),
        "roman": len(re.findall(P.ROMAN_HEAD, text)) >= 2,
        "bullet": re.search(P.INSTRUCTION_BULLET, text),
        "sheet": re.search(P.SHEET_HEAD, text, re.I),
    }
    assert not [name for name, hit in found.items() if hit and not bits & H.BITS[name]]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=6).map("".join))
def test_no_heading_without_its_word(text):
    assert not re.search(P.HEADING_LINE, text) or H.folded(text) or any(w in text.lower() for w in H.HEADING)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(TALK), max_size=4).map("".join))
def test_no_speech_without_its_first_letters(text):
    assert H.first_words_of(P.META)(text) or not re.match(rf"\s*(?:{P.META_BODY})", text, re.I)


def test_hints_and_foreign_letters():
    assert H.hints("Nothing here.") == 0 and H.hints("The ſame.") == H.ALL
    assert H.hints("Step 1. Note: x") == H.BITS["format"]
    assert [H.foreign_count(t) for t in ("plain", "café “x”…", "一丁")] == [0, 1, 2]


def test_strip_by_slices(spark):
    texts = [None, "", *(f"# T{i}\nThe café is {i}. Step {i}" for i in range(600)), *(f"Plain {i}." for i in range(50))]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").coalesce(1)
    got = rows.select("i", stripped(F.col("t"), hinted=True).alias("s")).select("i", "s.*").orderBy("i").collect()
    assert [tuple(r[1:4]) for r in got] == [strip_wrappers(t) for t in texts]
    assert [(r["foreign"], r["hints"]) for r in got[2:602]] == [(1, H.BITS["format"])] * 600
    assert spark.createDataFrame([], "t string").select(stripped(F.col("t"))).count() == 0


def test_judged_texts_are_looked_through_once(spark, sf_dir):
    plan = catalog.queries()["verdicts"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "xxhash64(slice(" not in plan and "ArrowEvalPython" in plan and plan.count("ArrowEvalPython") == 1
    assert plan.count("hints") > 0

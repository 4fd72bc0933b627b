import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from prosemill.llm.components import connected_components
from prosemill.llm.simhash import near_links, simhash64, simhash_groups


def brute_simhash(text):
    words = [w for w in text.lower().replace("\t", " ").replace("\n", " ").split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(nodes, links):
    up = {n: n for n in nodes}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


@pytest.mark.parametrize("text", ["", " \t\n", "One", "a b c", "a b c d", "A b C d e f g a b c d", "x " * 1000, "é ü \n ß a"])
def test_fingerprint(text):
    assert simhash64(text) == brute_simhash(text)
    assert simhash64(None) == 0


def test_the_session_hash_is_the_same(spark):
    assert spark.sql("SELECT xxhash64('ab c')").first()[0] % 2**64 == xxhash.xxh64_intdigest(b"ab c", 42)


def test_components(spark):
    rng = random.Random(4)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2001 + i) for i in range(200)] + [(5, 5)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame([*links, (None, 3)], "a long, b long")).collect()}
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert got == roots(linked, [x for x in links if x[0] != x[1]])
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def hamming_groups(values, bits):
    v = np.array(values, np.int64)
    near = np.argwhere(np.bitwise_count((v[:, None] ^ v[None, :]).view(np.uint64)) <= bits)
    return roots(values, [(values[i], values[j]) for i, j in near if i < j])


@pytest.mark.parametrize("block", [4096, 7])
def test_links_lose_nothing(spark, block):
    rng = random.Random(9)
    centres = [rng.getrandbits(64) for _ in range(40)]
    values = set(centres) | {0, 1, 2**64 - 1}
    for c in centres:
        for _ in range(8):
            x = c
            for b in rng.sample(range(64), rng.randint(1, 7)):
                x ^= 1 << b
            values.add(x)
    hot = centres[0]  # very many fingerprints in one bucket
    values |= {hot ^ (1 << a) ^ (1 << b) for a in range(22, 64) for b in range(22, a)}
    values = [int(np.uint64(x).astype(np.int64)) for x in values]
    fps = spark.createDataFrame([(x,) for x in values], "fp long").repartition(5)
    linked = {r["node"]: r["component"] for r in connected_components(near_links(fps, 4, block)).collect()}
    assert {v: linked.get(v, v) for v in values} == hamming_groups(values, 4)


def test_groups_with_nulls_repeats_and_foreign_columns(spark):
    long = "word " * 200_000
    rows = [(5, None), (3, ""), (9, " "), (7, "a b c d e"), (7, "a b c d e"), (2, "A B c d e"), (None, "a b c d e"), (None, "quite another text here"), (11, long), (10, long)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit("x")).withColumn("bucket", F.lit(1)).withColumn("node", F.lit(2))
    got = [(r["doc_id"], r["component_id"]) for r in simhash_groups(docs).collect()]
    expected = [(5, 3), (3, 3), (9, 3), (7, 2), (7, 2), (2, 2), (None, 2), (None, None), (11, 10), (10, 10)]
    assert sorted(got, key=str) == sorted(expected, key=str)
    assert simhash_groups(docs.limit(0)).count() == 0

"""Periodic runs against a brute-force scan of every period."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tierline.llm import queries, runs

SCHEMA = "doc_id LONG, text STRING, n_words LONG, runs STRING, _key STRING, `a.b` LONG"


def brute(words, least=6, power=4):
    found = {}
    for q in range(1, len(words) // power + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, power * q):
                found.setdefault((i, j + q - i), q)
            i = j
    return sorted((s, n, q) for (s, n), q in found.items())


def listed(lists, **kinds):
    text, *spans = runs.text_runs(lists, **kinds)
    out = [[] for _ in lists]
    for t, s, n, q in zip(text.tolist(), *(c.tolist() for c in spans)):
        out[t].append((s, n, q))
    return out


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=40), max_size=5), st.sampled_from([(6, 4), (2, 2), (8, 2), (3, 3)]))
def test_runs_are_those_of_brute_force(lists, kind):
    assert listed(lists, least=kind[0], power=kind[1]) == [brute(w, *kind) for w in lists]


def test_long_texts_and_nested_runs():
    rng = np.random.default_rng(3)
    words = [str(x) for x in rng.integers(0, 500, 30000)]
    looped = [words[i] if i < 2000 else words[2000 + (i - 2000) % 4000] for i in range(30000)]
    nested = ("x y " * 5 + "z ").split() * 6
    assert listed([words, looped, nested, ["a"] * 20000]) == [[], [(2000, 28000, 4000)], brute(nested), [(0, 20000, 1)]]


def test_suffix_order():
    rng = np.random.default_rng(5)
    symbols = np.concatenate([rng.integers(1, 4, 200), [0]])
    sa, lcp, _ = runs.suffix_order(symbols)
    suffixes = sorted(range(201), key=lambda i: symbols[i:].tolist())
    assert sa.tolist() == suffixes
    for k in range(1, 201):
        a, b = symbols[sa[k - 1] :].tolist(), symbols[sa[k] :].tolist()
        assert lcp[k] == next(i for i in range(201) if a[i] != b[i])


def expected(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if doc_id is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute(words)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None, None, None)
    return (
        doc_id, len(found), *best, best[1] and 1000 * best[1] // best[2],
        hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()).hexdigest(),
        hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in gone).encode()).hexdigest(),
    )


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(9)
    out = [(i, " ".join(rng.choice(list("abcdefgh"), int(rng.integers(0, 60))))) for i in range(120)]
    out += [(120, None), (121, ""), (122, " \t\n\x0b\x0c\r "), (None, "a b " * 9), (None, None), (123, "    " * 5)]
    out += [(5, "go " * 50), (5, "go " * 50), (124, "no blanks"), (125, "Tie tie " * 4 + "x " + "tie Tie " * 4)]
    return out


def test_digests_of_looped_texts(spark, texts):
    frame = spark.createDataFrame([(i, t, 1, "r", "k", 2) for i, t in texts], SCHEMA).repartition(4)
    got = runs.run_digests(runs.find_runs(runs.looped(frame)))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted((expected(*d) for d in texts), key=str)
    assert any(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in texts)


def test_found_runs_and_collapsed_text(spark):
    frame = spark.createDataFrame([("k1", "to be or to be or to be or to be or not"), ("k2", None)], "k STRING, t STRING")
    rows = {r["k"]: r for r in runs.find_runs(frame, "k", "t").collect()}
    assert [tuple(r) for r in rows["k1"]["runs"]] == [(0, 12, 3)] and rows["k1"]["collapsed"] == "to be or not"
    assert rows["k1"]["n_words"] == 13 and rows["k2"]["runs"] == [] and rows["k2"]["collapsed"] == ""


def test_empty_table_and_refused_settings(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert runs.run_digests(runs.find_runs(runs.looped(none))).count() == 0
    with pytest.raises(ValueError):
        runs.find_runs(none, power=1)


def test_query_is_registered():
    assert "op11_periodic_runs" in queries.QUERIES and "op11_periodic_runs" not in queries.SQL

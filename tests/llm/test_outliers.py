"""Quality rules: counts against plain Python, verdicts against NumPy."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np

from riskloom.llm import outliers

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_words int, _key int, kept string"


def counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    many = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if many[w] > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(inside),
        len(lines),
    )


def numbers(r):
    return r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words


def frame(spark, rows):
    return spark.createDataFrame([(*x, 1, 2, "x") for x in rows], SCHEMA)


def concentrated(x):
    """Medians, then the same steps with the half taken exactly."""
    n, d = x.shape
    floor = np.diag([v**2 for v in outliers.FLOORS.values()])
    quartiles = np.quantile(x, [0.25, 0.5, 0.75], axis=0)
    mean, cov = quartiles[1], np.diag(((quartiles[2] - quartiles[0]) / 1.349) ** 2) + floor
    for _ in range(outliers.STEPS):
        z = x - mean
        d2 = np.einsum("ni,ij,nj->n", z, np.linalg.inv(cov), z)
        half = np.argsort(d2, kind="stable")[: math.ceil((n + d + 1) / 2)]
        mean, cov = x[half].mean(0), np.cov(x[half].T, bias=True) + floor
    z = x - mean
    d2 = np.einsum("ni,ij,nj->n", z, np.linalg.inv(cov), z)
    scale = max(1.0, np.sort(d2)[math.ceil((n + d + 1) / 2) - 1] / outliers.MEDIAN)
    return np.sqrt(d2 / scale)


def prose(r, n):
    return " ".join("".join(r.choice("abcdefgh") for _ in range(r.randrange(2, 9))) for _ in range(n))


def corpus(seed, n=700):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        text = prose(r, r.randrange(25, 300))
        kind = r.random()
        if kind < 0.05:
            text = " ".join(w + r.choice(["###", "$$$", "%%%"]) for w in text.split())
        elif kind < 0.1:
            text = "\n".join([text[:90]] * 3 + [prose(r, 200)])
        elif kind < 0.13:
            text = " ".join(w * 5 for w in text.split())
        rows.append((i, text, r.choice(["en", "de"]), r.choice(["a", "a", "a", "b"])))
    return rows


def test_counts_and_verdicts(spark):
    rows = corpus(1)
    got = {r.doc_id: r for r in outliers.quality_rules(frame(spark, rows)).collect()}
    assert len(got) == len(rows)
    groups = {}
    own = Counter()
    for i, text, lang, source in rows:
        c = counts(text)
        assert numbers(got[i]) == c[:5]
        failed = c[0] < 20 or 100 * c[4] > 30 * c[0]
        assert got[i].base_failed == failed
        own[lang, source] += not failed
        v = [math.log((c[1] + 1) / (c[0] + 1)), (c[2] / (c[1] + 200)) ** 0.5, (c[3] / (c[5] + 10)) ** 0.5, (c[4] / (c[0] + 20)) ** 0.5]
        groups.setdefault((lang, source), []).append((i, v, failed))
    merged = {}
    small = Counter()
    for (lang, source), n in own.items():
        if n < outliers.LEAST_ROWS:
            small[lang] += n
    for (lang, source), found in groups.items():
        key = (lang, source) if own[lang, source] >= outliers.LEAST_ROWS else lang if small[lang] >= outliers.LEAST_ROWS else None
        merged.setdefault(key, []).extend(x for x in found if not x[2])
    assert len(merged) > 1
    for found in merged.values():
        want = concentrated(np.array([v for _, v, _ in found]))
        have = np.array([got[i].distance for i, _, _ in found])
        # a half cut at a bin and approximate quartiles move the estimate a little
        assert (np.abs(have - want) <= 0.05 + 0.2 * want).all()
        clear = np.abs(want**2 / outliers.CUTOFF - 1) > 0.5
        kept = np.array([got[i].kept for i, _, _ in found])
        assert (kept == (want**2 <= outliers.CUTOFF))[clear].all()
        assert not kept[want > 12].any() and kept[want < 4].all()


def test_each_statistic_rejects_alone(spark):
    r = random.Random(6)
    line = lambda: prose(r, 12)
    rows = [(i, "\n".join(line() for _ in range(12)), "en", "a") for i in range(300)]
    rows.append((1000, "\n".join(["one short line"] * 10 + [line() for _ in range(10)]), "en", "a"))
    words = prose(r, 300).split()
    rows.append((1001, " ".join(words + words[:50]), "en", "a"))
    text = prose(r, 300)
    rows.append((1002, text + " " + "#" * (len(text) // 28), "en", "a"))
    got = {x.doc_id: x for x in outliers.quality_rules(frame(spark, rows)).collect()}
    assert not any(got[i].base_failed or got[i].kept for i in (1000, 1001, 1002))
    assert sum(got[i].kept for i in range(300)) >= 297


def test_few_rows_left_over_are_judged_by_the_whole_table(spark):
    r = random.Random(8)
    rows = [(i, prose(r, 60), "en", "a") for i in range(250)]
    rows += [(1000, prose(r, 60), "xx", "b"), (1001, prose(r, 60) + " " + "#" * 100, "xx", "b"), (1002, "few", "xx", "c")]
    got = {x.doc_id: x for x in outliers.quality_rules(frame(spark, rows)).collect()}
    assert len(got) == len(rows) and got[1000].kept and not got[1001].kept and not got[1002].kept
    assert got[1000].distance is not None and not got[1001].base_failed


def test_edges(spark):
    long = prose(random.Random(3), 30_000)
    rows = [(1, None, None, None), (2, "", "en", "a"), (3, " \n\t ", "en", None), (4, "a b\x0bc\x85d\xa0e\n\n a", "en", "a")]
    rows += [(5, "x y\nx y\n x y\n", "en", "a"), (6, "w " * 200, "en", "a"), (7, long, "en", "a"), (None, long, None, "a")]
    rows += [(8, "a b c d e f g h i a b c d e f g h " + "a b c d e f g h", "en", "a"), (7, long, "en", "a"), (9, "ä|ß<>&%$*#", "x", "y")]
    got = outliers.quality_rules(frame(spark, rows)).collect()
    want = sorted(str((i, *counts(t)[:5])) for i, t, _, _ in rows)
    assert sorted(str((r.doc_id, *numbers(r))) for r in got) == want
    # too few rows for estimates: the base rule decides
    assert all(r.kept == (not r.base_failed) and r.distance is None for r in got)


def test_no_language_columns_and_empty(spark):
    r = random.Random(4)
    df = spark.createDataFrame([(i, prose(r, 40)) for i in range(40)], "doc_id long, text string")
    assert all(x.kept and x.distance is not None for x in outliers.quality_rules(df).collect())
    assert outliers.quality_rules(df.limit(0)).collect() == []


def test_identical_rows_have_no_spread(spark):
    r = random.Random(5)
    text = prose(r, 50)
    rows = [(i, text, "en", "a") for i in range(300)] + [(1000, text + " " + "#" * 400, "en", "a")]
    got = {x.doc_id: x.kept for x in outliers.quality_rules(frame(spark, rows)).collect()}
    assert not got.pop(1000) and all(got.values())

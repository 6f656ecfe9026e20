"""Normality, paired tests, resampling and the matcher against plain versions, on groups of many sizes."""

import random
from difflib import SequenceMatcher

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmill.operators import matching, order, resample, stats


def test_normal_quantile(spark):
    shares = [1e-300, 1e-12, 0.001, 0.0749, 0.0751, 0.2, 0.5, 0.7, 0.925, 0.9999]
    found = spark.createDataFrame([(p,) for p in shares], "p double").select("p", order.normal_quantile(F.col("p")).alias("q")).collect()
    for r in found:
        if r["p"] > 1e-9:
            assert r["q"] == pytest.approx(stats._quantile(r["p"]), abs=1e-9)
    # values of the far tail from tables
    assert found[0]["q"] == pytest.approx(-37.0471, abs=1e-4) and found[1]["q"] == pytest.approx(-7.0344838253, abs=1e-9)


def _groups():
    rng = np.random.default_rng(4)
    made = {f"n{n}": rng.normal(size=n) for n in (1, 2, 3, 4, 5, 6, 11, 12, 60, 400)}
    made |= {"ties": rng.integers(-2, 3, 3000) * 1.0, "hot": np.r_[np.zeros(6000), rng.normal(size=5500)], "same": np.full(9, 2.0), "zero": np.zeros(4), "skew": rng.exponential(size=50) ** 2, "shift": rng.normal(size=40) + 1.5}
    return made


@pytest.mark.parametrize("run", [4096, 100])
def test_tests_of_groups_of_every_size(spark, monkeypatch, run):
    monkeypatch.setattr(order, "RUN", run)
    groups = _groups()
    rows = [(g, float(x), 0.0) for g, d in groups.items() for x in d] + [("n3", None, 0.0), ("n4", float("nan"), 1.0)]
    frame = spark.createDataFrame(rows, "g string, a double, b double").repartition(5)
    found = {r["g"]: r for r in stats.compare(frame.withColumnRenamed("g", "stage"), "stage").withColumnRenamed("stage", "g").collect()}
    w = {r["g"]: r for r in stats.normality(frame, "g", "a").collect()}
    for g, d in groups.items():
        test, p = stats.paired_test(d, np.zeros(len(d)))
        assert (found[g]["test"], found[g]["n"]) == (test, len(d))
        assert found[g]["p_value"] is None if np.isnan(p) else found[g]["p_value"] == pytest.approx(p, rel=1e-6, abs=1e-12)
        assert w[g]["n"] == len(d) and w[g]["p_value"] == pytest.approx(stats.shapiro_wilk(d), rel=1e-6, abs=1e-9)
    assert stats.compare(frame.limit(0), "g").count() == 0 and stats.normality(frame.limit(0), "g", "a").count() == 0


def test_intervals_do_not_follow_the_partitions(spark, monkeypatch):
    rng = random.Random(2)
    rows = [(i, "ab"[i % 3 == 0], rng.random()) for i in range(900)] + [(901, "a", None), (902, "c", 5.0), (903, "d", float("nan"))]
    frame = spark.createDataFrame(rows, "k long, g string, s double")
    seen = []
    for parts, groups in ((1, 512), (7, 512), (3, 1)):
        monkeypatch.setattr(resample, "GROUPS", groups)
        found = resample.intervals(frame.repartition(parts), "g", "s", "k", rounds=300).collect()
        seen.append({r["g"]: (round(r["low"], 10), round(r["high"], 10)) for r in found})
    assert seen[0] == seen[1] == seen[2] and set(seen[0]) == {"a", "b", "c"} and seen[0]["c"] == (5.0, 5.0)
    values = np.array([s for _, g, s in rows if g == "a" and s is not None])
    half = 1.96 * values.std() / np.sqrt(len(values))
    assert seen[0]["a"] == pytest.approx((values.mean() - half, values.mean() + half), abs=0.3 * half)
    other = resample.intervals(frame, "g", "s", "k", rounds=300, seed=7).where("g = 'a'").first()
    assert other["low"] != pytest.approx(seen[0]["a"][0], abs=1e-12)
    assert resample.intervals(frame.limit(0), "g", "s", "k").count() == 0


def test_draws_are_those_of_poisson():
    drawn = resample.counts(np.arange(4000), 500, 42)
    assert abs(drawn.mean() - 1) < 0.005 and abs(drawn.var() - 1) < 0.01
    # rounds and rows do not follow each other
    assert abs(np.corrcoef(drawn[:, 0], drawn[:, 1])[0, 1]) < 0.05 and abs(np.corrcoef(drawn[0], drawn[1])[0, 1]) < 0.15
    assert abs(drawn.mean(0).std() * np.sqrt(4000) - 1) < 0.1


def _edited(rng, text, alphabet):
    out = list(text)
    for _ in range(rng.randrange(25)):
        i = rng.randrange(len(out) + 1)
        move = rng.randrange(3)
        if move == 0:
            del out[i : i + rng.randrange(1, 20)]
        elif move == 1:
            out[i:i] = [rng.choice(alphabet) for _ in range(rng.randrange(1, 20))]
        else:
            out[i:i] = out[: rng.randrange(60)]
    return "".join(out)


@pytest.mark.parametrize("area", [1, 30, 4096])
def test_matching_blocks_of_random_texts(monkeypatch, area):
    monkeypatch.setattr(matching, "AREA", area)
    rng = random.Random(area)
    alphabets = ["ab", "abcdefghijklmnopqrstuvwxyz     ", "".join(map(chr, range(0x4E00, 0x4E00 + 300))), "".join(map(chr, range(33, 123))), "aé\U0001f600퟿"]
    for _ in range(250):
        alphabet = rng.choice(alphabets)
        b = "".join(rng.choice(alphabet) for _ in range(rng.choice([0, 1, 5, 199, 200, 230, 700])))
        a = _edited(rng, b, alphabet) if rng.random() < 0.7 else "".join(rng.choice(alphabet) for _ in range(rng.randrange(400)))
        assert matching.ratio(a, b) == SequenceMatcher(None, a, b).ratio()
    assert matching.ratio("", "") == 1.0 and matching.ratio("", "x") == 0.0


def test_matching_stays_cheap_on_long_texts():
    import time

    rng = random.Random(3)
    words = ["".join(rng.choice("etaoinshrdlucmfwypvbgkqjxzéü") for _ in range(rng.randint(2, 9))) for _ in range(3000)]
    b = " ".join(rng.choice(words) + rng.choice(["", ",", ".", "!", "Q", "7"]) for _ in range(150_000))
    a = "".join(_edited(rng, b[i : i + 2000], "abc xyz") for i in range(0, len(b), 2000))
    start = time.process_time()
    assert 0 < matching.ratio(a, b) < 1 and time.process_time() - start < 20

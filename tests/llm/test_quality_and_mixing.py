"""Quality rules and source mixing against plain versions."""

import math
from collections import Counter

import numpy as np
import pytest
from brute import ODD, WORD, base_quality, targets
from llm_fixtures import labelled, make  # noqa: F401
from pyspark.sql import functions as F

from urbanlake.llm import mixing, quality


def texts(seed, n):
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        words = rng.choice(["the", "of", "and", "to"] + [f"w{k}" for k in range(60)], rng.integers(1, 120)).tolist()
        if i % 5 == 0:
            words += words[:20] * 2
        if i % 7 == 0:
            words = [w + "###" for w in words]
        out.append("\n".join(" ".join(words[k:k + 9]) for k in range(0, len(words), 9)))
    return out


def test_base_counts_and_verdicts(make, labelled):
    rows = ODD + [(100 + i, t, "a") for i, t in enumerate(texts(1, 60))] + [(300, "a<b|c>\n\na<b|c>\n \n#é ü", "a")]
    labels = labelled([(100 + i, int(i % 7 != 0), 0) for i in range(0, 60, 2)] + [(102, 0, 0), (1, None, None), (None, 1, 1)])
    got = quality.quality_rules(make(rows), labels, threshold=-0.01, prior=1e3).collect()
    assert len(got) == len(rows)
    key = lambda x: tuple(str(v) for v in x)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert sorted(((r.doc_id, *(r[n] for n in names)) for r in got), key=key) == sorted(((i, *base_quality(t)) for i, t, _ in rows), key=key)
    for r in got:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert r.kept == (not r.base_failed and r.score >= -0.01)
    assert {True, False} == {r.kept for r in got if not r.base_failed}


def test_scores_are_the_smoothed_ratios_mean(spark, make, labelled):
    """With more bins than grams collide rarely, so the score equals the one from exact gram counts."""
    rows = [(i, t, "a") for i, t in enumerate(texts(3, 25))]
    good = {i for i in range(0, 25, 3)}
    grams = {i: Counter(g for w in [WORD.findall(t)] for g in [*((x,) for x in w), *zip(w, w[1:], strict=False)]) for i, t, _ in rows}
    raw, target = sum(grams.values(), Counter()), sum((grams[i] for i in good), Counter())
    mu, all_raw, all_target = 500.0, sum(raw.values()), sum(target.values())
    want = {i: sum(n * math.log((target[g] * all_raw / raw[g] + mu) / (all_target + mu)) for g, n in c.items()) / c.total()
            for i, c in grams.items()}
    got = quality.quality_rules(make(rows), labelled([(i, int(i in good), 0) for i in range(25)]), buckets=1 << 20, prior=mu).collect()
    assert {r.doc_id: r.score for r in got} == pytest.approx(want, abs=1e-3)


def test_kept_rows_come_back_as_they_are(make, labelled):
    docs = make([(i, t, "a") for i, t in enumerate(texts(4, 30))])
    labels = labelled([(i, 1, 0) for i in range(0, 30, 2)])
    kept = {r.doc_id for r in quality.quality_rules(docs, labels).collect() if r.kept}
    back = quality.good_documents(docs, labels)
    assert back.columns == docs.columns
    assert sorted(map(tuple, back.collect()), key=str) == sorted((tuple(r) for r in docs.collect() if r.doc_id in kept), key=str)


def prose(seed, n):
    """Documents of one mix, every fifth bad and labelled so, every other good one labelled."""
    rng = np.random.default_rng(seed)
    good, bad = [f"w{k}" for k in range(300)], [f"junk{k}" for k in range(40)]
    rows, told = [], []
    for i in range(n):
        words = rng.choice(good, 60).tolist()
        if i % 5 == 0:
            words[::2] = rng.choice(bad, 30).tolist()
        rows.append((i, " ".join(words), "a"))
        if i % 5 == 0 or i % 2 == 0:
            told.append((i, int(i % 5 != 0), 0))
    return rows, told


@pytest.mark.parametrize("n", [100, 3000])
def test_verdicts_do_not_switch_with_size(make, labelled, n):
    """With the production values, bad documents go and good ones stay, labelled or not, in a small and a large mix."""
    rows, told = prose(5, n)
    got = quality.quality_rules(make(rows), labelled(told)).collect()
    assert not any(r.base_failed for r in got)
    assert {(r.doc_id % 5 != 0, r.kept) for r in got} == {(True, True), (False, False)}


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_labelled_documents_of_the_tables(spark, size):
    path = f"/root/testdata/{size}"
    labels = spark.read.parquet(f"{path}/labels.parquet")
    told = {r.doc_id: r.quality for r in labels.groupBy("doc_id").agg(F.max("quality").alias("quality")).collect()}
    got = quality.quality_rules(spark.read.parquet(f"{path}/documents.parquet"), labels).select("doc_id", "base_failed", "kept").collect()
    kept = lambda q: [r.kept for r in got if not r.base_failed and told.get(r.doc_id) == q]
    good, bad = kept(1), kept(0)
    assert bad and sum(bad) <= 0.05 * len(bad) and sum(good) >= 0.98 * len(good)


def test_quality_without_labels_or_documents(make, labelled):
    docs = make([(1, "word " * 25, "a")])
    assert quality.quality_rules(docs, labelled([])).first().score == 0.0
    assert quality.quality_rules(docs.limit(0), labelled([])).count() == 0
    assert quality.good_documents(docs.limit(0), labelled([])).count() == 0


def mixed_rows():
    rng = np.random.default_rng(9)
    sources = ["b", "a", "é", "z", None, "B", "empty"]
    rows = [(i, " ".join(["w"] * int(rng.integers(1, 40))), sources[min(int(rng.exponential(1.2)), 5)]) for i in range(900)]
    return rows + [(1000, None, "empty"), (1001, " ", "empty"), (None, "no id", "a"), (3, "again", "a"), (3, "again", "a")]


def test_targets_and_taken_words(make):
    rows = mixed_rows()
    plan = mixing.mixing_plan(make(rows), shards=8).collect()
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(WORD.findall(t or ""))
    want = targets(sizes)
    assert len(plan) == len(rows)
    by_size = {(r.source_size, round(r.target, 6)) for r in plan}
    assert by_size == {(sizes[s], round(want[s], 6)) for s in sizes}
    taken, most = Counter(), Counter()
    for r in plan:
        n = len(r.shards)
        assert n <= 2 and all(0 <= x < 8 for x in r.shards)
        taken[r.source_size] += n * r["size"]
        most[r.source_size] = max(most[r.source_size], r["size"])
    for s in sizes:
        assert abs(taken[sizes[s]] - want[s]) <= most[sizes[s]], s
    assert {x for r in plan for x in r.shards} == set(range(8))
    assert sorted(map(str, plan)) == sorted(map(str, mixing.mixing_plan(make(rows).repartition(5), shards=8).collect()))


def test_mixed_documents_are_the_plan(make):
    docs = make(mixed_rows())
    plan = Counter()
    for r in mixing.mixing_plan(docs).collect():
        plan[r.doc_id] += len(r.shards)
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    assert Counter(r.doc_id for r in mixed.collect()) == +plan


@pytest.mark.parametrize("giant", [5_000, 11_000])
def test_one_giant_document_does_not_stop_the_fill(make, giant):
    """Whichever place the giant's hash gives it, the small documents behind it reach the target."""
    rows = [(1000 * s + i, "w " * (giant if i == 0 else 100), f"s{s}") for s in range(6) for i in range(101)]
    rows += [(None, f"{i} " + "w " * 9, "z") for i in range(2000)]
    plan = mixing.mixing_plan(make(rows), budget=0.7, shards=4).collect()
    taken, of, times = Counter(), {}, set()
    for r in plan:
        group = "z" if r.doc_id is None else r.doc_id // 1000
        taken[group] += len(r.shards) * r["size"]
        of[group] = r
        if r.doc_id is None:
            times.add(len(r.shards))
    assert abs(taken["z"] - of["z"].target) <= 5 and len(times) == 2
    for group in range(6):
        size, want = of[group].source_size, of[group].target
        best = min(abs(want - want // size * size - g * giant - k * 100) for g in (0, 1) for k in range(101))
        assert abs(taken[group] - want) == pytest.approx(best), (group, taken[group], want)


def test_leaves_hold_the_exact_quotas(spark):
    quotas = spark.createDataFrame([(0, 700), (1, 0), (2, 123), (3, 1)], "rank int, quota long")
    for shards in (1, 3, 8, 100):
        rows = mixing.shard_quotas(quotas, shards, 5).collect()
        total, of_shard = Counter(), Counter()
        for r in rows:
            assert r.blocks >= 0
            total[r["rank"]] += r.blocks
            of_shard[r.shard] += r.blocks
        assert [total[i] for i in range(4)] == [700, 0, 123, 1]
        assert len(of_shard) == shards and max(of_shard.values()) - min(of_shard.values()) <= shards


def test_hypergeometric_quantiles(spark):
    """The draws' cumulative distribution, against exact sums of binomials."""
    rows = [(20, 7, 9, (i + 0.5) / 97) for i in range(97)] + [(5, 5, 3, 0.5), (5, 0, 3, 0.5), (6, 3, 0, 0.9), (6, 3, 6, 0.1)]
    df = spark.createDataFrame(rows, "n long, k long, m long, u double")
    for r in df.withColumn("x", mixing.hypergeometric(F.col("n"), F.col("k"), F.col("m"), F.col("u"))).collect():
        cdf = lambda x, r=r: sum(math.comb(r.k, i) * math.comb(r.n - r.k, r.m - i) for i in range(x + 1)
                                 if r.m - i >= 0) / math.comb(r.n, r.m)
        assert cdf(r.x) >= r.u - 1e-12 and (r.x == 0 or cdf(r.x - 1) < r.u + 1e-12)


def test_empty_mix(make):
    none = make([(1, "x", "a")]).limit(0)
    assert mixing.mixing_plan(none).count() == 0 and mixing.mixed_documents(none).count() == 0


def test_sources_without_words(make):
    plan = mixing.mixing_plan(make([(1, None, "a"), (2, " ", None)])).collect()
    assert [(r["size"], r.source_size, len(r.shards)) for r in plan] == [(0, 0, 0)] * 2

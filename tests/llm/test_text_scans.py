"""License scans, toxicity and language-model scores."""

import math

import numpy as np
import pytest
from brute import ODD, backoff, marginals, phrases
from llm_fixtures import labelled, make  # noqa: F401
from pyspark.sql import functions as F

from urbanlake.llm import licenses, lmscore, toxicity

NOTICE = "Permission is hereby granted, free of charge, to any person obtaining a copy"


def test_base_phrases_match_brute_force(make):
    rows = ODD + [(20, "CC BY cc by CC-BY; cc  by\nMIT license MIT License", "a"), (21, "The GNU General\tPublic license.", "a"),
                  (22, "xmit license mit licensex accc by é mit license", "a"), (23, "Apache Licensé apache license", "a")]
    got = licenses.license_scan(make(rows)).collect()
    key = lambda x: tuple(str(v) for v in x)
    assert sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got), key=key) == sorted(
        ((i, *phrases(t, licenses.PHRASES)) for i, t, _ in rows), key=key)


def edited(text, edits, rng):
    chars = list(text)
    for _ in range(edits):
        at = int(rng.integers(1, len(chars) - 1))
        kind = int(rng.integers(3))
        if kind == 0:
            chars[at] = "q"
        elif kind == 1:
            chars.insert(at, "q")
        else:
            del chars[at]
    return "".join(chars)


def test_every_notice_within_its_errors_is_found():
    scanner, rng = licenses.Scanner(), np.random.default_rng(3)
    for notice, label in licenses.NOTICES.items():
        for edits in range(licenses.max_edits(notice) + 1):
            for _ in range(8):
                text = f" before {edited(notice, edits, rng)} after "
                spans = [s for s in scanner.fuzzy(text) if s[3] == label]
                assert spans and min(s[2] for s in spans) <= edits, (text, edits)


def test_spans_labels_and_score():
    out = licenses.scan_text(f"Some words. {NOTICE.replace('hereby', 'herby')} of it.".encode(), licenses.Scanner())
    assert out["labels"] == "mit-notice" and out["base_labels"] == "" and 0.9 < out["score"] < 1
    (span,) = out["spans"]
    joined = " ".join(w.decode() for w in licenses.WORD.findall(f"Some words. {NOTICE.replace('hereby', 'herby')} of it.".lower().encode()))
    assert joined[span["start"]:span["end"]].startswith("permission is herby") and span["edits"] == 1
    clean = licenses.scan_text(b"nothing of this kind stands here", licenses.Scanner())
    assert clean["labels"] == "" and clean["score"] == 0.0 and clean["spans"] == []


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def best_first(words, notice, errors):
    """Errors of the runs of words that match: the best run first, then what doesn't overlap it."""
    runs = [(distance(" ".join(words[i:j]), notice), i, j) for i in range(len(words)) for j in range(i + 1, min(len(words), i + 9) + 1)]
    taken = []
    for e, i, j in sorted(runs):
        if e <= errors and all(j <= a or b <= i for _, a, b in taken):
            taken.append((e, i, j))
    return [e for e, _, _ in sorted(taken, key=lambda x: x[1])]


def test_every_repeat_of_a_notice_is_found():
    scanner, rng, notice = licenses.Scanner(), np.random.default_rng(8), "licensed under the mit license"
    found = lambda text: [s[2] for s in scanner.fuzzy(f" {text} ") if s[3] == "mit-notice"]
    assert found("licensed undr the mit license " * 20 + notice) == [1] * 20 + [0]
    assert found(f"licensed undr the mitt license {notice}") == [2, 0]
    for _ in range(20):
        text = " ".join(edited(notice, int(rng.integers(licenses.max_edits(notice) + 1)), rng) for _ in range(6))
        assert found(text) == best_first(text.split(" "), notice, licenses.max_edits(notice)), text


def test_marginals_match_all_sequences():
    rng = np.random.default_rng(4)
    move = rng.standard_normal((2, 2))
    lengths = np.array([3, 1, 6, 2])
    potential = rng.standard_normal(lengths.sum())
    p, pairs, _ = toxicity.Chains(lengths).marginals(potential, move)
    at = 0
    for n in lengths:
        assert p[at:at + n] == pytest.approx(marginals(potential[at:at + n], move))
        at += n
    assert pairs.sum() == pytest.approx((lengths - 1).sum())


def toxic_rows(seed=1, n=400):
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(200)]
    docs, labels = [], []
    for i in range(n):
        text = rng.choice(words, 60).tolist()
        bad = i % 4 == 0
        if bad:
            for at in rng.integers(0, 60, 4):
                text[at] = str(rng.choice(["vile", "scum", "vequka", "vequlo"]))
        docs.append((i, " ".join(text), "a"))
        labels.append((i, 1, int(bad)))
    return docs, labels


def test_toxic_documents_of_the_held_out_fold(spark, make, labelled):
    docs, labels = toxic_rows()
    told = labelled(labels + [(None, 1, 1), (5, 1, None), (5, 1, 0)])
    rows = docs + [(1000, None, "a"), (1001, "", "a"), (None, "vile scum here", "a"), (1002, "w1 w2 " * 30_000, "a"), (7, docs[7][1], "a")]
    got = toxicity.toxicity(make(rows), told).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert all((by[i].score >= 0.5) == bool(y) for i, _, y in labels)
    assert by[1000].score == by[1001].score < 0.5 and by[1002].score < 0.5 and by[None].score >= 0.5
    for i, t, _ in docs[:8]:
        marked = {t[s.start:s.end] for s in by[i].spans}
        assert all(any(w in m for w in ("vile", "scum", "vequ")) for m in marked) and bool(marked) == (i % 4 == 0)
    clean = toxicity.without_toxic(make(rows), told)
    assert clean.columns == make(rows).columns
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in got if r.score < 0.5}


def test_held_out_labels_are_not_learnt(spark, make, labelled):
    """With the held-out fold's labels turned round, every score stays as it is."""
    import zlib
    docs, labels = toxic_rows(n=120)
    out = lambda i: zlib.crc32(str(i).encode()) % 5 == 0
    turned = [(i, q, 1 - y if out(i) else y) for i, q, y in labels]
    a = toxicity.toxicity(make(docs), labelled(labels)).collect()
    b = toxicity.toxicity(make(docs), labelled(turned)).collect()
    assert sorted(a) == sorted(b)
    folds = make(docs).select("doc_id", toxicity.held_out(F.col("doc_id")).alias("h")).collect()
    assert all(r.h == out(r.doc_id) for r in folds)


def test_without_labels_of_both_kinds(make, labelled):
    docs = make([(1, "a b", "a"), (2, None, "a")])
    assert [r.score for r in toxicity.toxicity(docs, labelled([(1, 1, 0)])).collect()] == [0.0, 0.0]
    assert toxicity.without_toxic(docs, labelled([])).count() == 2
    assert toxicity.toxicity(docs.limit(0), labelled([])).count() == 0


@pytest.mark.parametrize("size,most_cuts", [(1_000_000, 1_000), (50, 1_000), (50, 6), (50, 3)])
def test_backoff_matches_brute_force(spark, make, monkeypatch, size, most_cuts):
    monkeypatch.setattr(lmscore, "BLOCK_TOKENS", size)
    monkeypatch.setattr(lmscore, "RANGE_GRAMS", max(40, size))
    monkeypatch.setattr(lmscore, "MOST_CUTS", most_cuts)
    rng = np.random.default_rng(6)
    rows = [(i, " ".join(rng.choice(["the", "The", "of", "a", "b", "c"], int(rng.integers(1, 30)))), "a") for i in range(40)]
    rows += [(50, None, "a"), (51, "", "a"), (52, "unique words only", "a"), (None, "the of a", "a"), (3, rows[3][1], "a")]
    want = backoff([t for _, t, _ in rows])
    got = lmscore.backoff_scores(make(rows)).collect()
    assert sorted(r.log_score for r in got) == pytest.approx(sorted(want))
    assert {r.doc_id: r.log_score for r in got}[52] == pytest.approx(want[42])


def test_backoff_of_one_and_of_no_document(make):
    one = lmscore.backoff_scores(make([(1, "a b c", "a")])).first()
    assert one.log_score == pytest.approx((1 + 2 + 3) * math.log(0.4)) and one.n_words == 3
    assert lmscore.backoff_scores(make([(1, "x", "a")]).limit(0)).count() == 0
    plain = lmscore.backoff_scores(make([(1, "a a", "a")]), order=2, leave_one_out=False).first()
    assert plain.log_score == pytest.approx(math.log(1.0) + math.log(1 / 2))


@pytest.mark.parametrize("top", [0, 1, 255, 256, 2**33, 2**64 - 1])
def test_numbers_come_back_from_planes(top):
    rng = np.random.default_rng(top % 1000)
    for n in (0, 1, 63, 64, 1000):
        x = rng.integers(0, top, n, dtype=np.uint64, endpoint=True)
        assert (lmscore.numbers(lmscore.planes(x)) == x).all()
    assert len(lmscore.planes(np.array([top], dtype=np.uint64))) <= 9


def test_no_list_is_cut_too_often():
    for ranges in (0, 1, 2, 999, 1_000, 1_001, 12_000, 10**6, 10**6 + 1, 4 * 10**7):
        fans = lmscore.cuts_for(ranges)
        assert max(fans) <= lmscore.MOST_CUTS and math.prod(fans) >= ranges
        assert len(set(fans)) == 1 and (fans[0] == 1 or (fans[0] - 1) ** len(fans) < ranges)
    assert lmscore.cuts_for(201) == [201] and lmscore.cuts_for(12_000) == [110, 110]


def test_rows_do_not_grow_with_blocks_times_ranges(spark, make, monkeypatch):
    """A level has at most ``MOST_CUTS`` rows for each list and order; without levels four times the words give over ten times the rows."""
    monkeypatch.setattr(lmscore, "BLOCK_TOKENS", 400)
    monkeypatch.setattr(lmscore, "RANGE_GRAMS", 1_500)
    rng = np.random.default_rng(8)
    rows, seen = {}, []
    totals = lmscore.gram_totals

    def counted(grams, *more):
        seen.append(grams.count())
        return totals(grams, *more)

    monkeypatch.setattr(lmscore, "gram_totals", counted)
    for most_cuts in (1_000, 8):
        monkeypatch.setattr(lmscore, "MOST_CUTS", most_cuts)
        for n in (150, 600):
            seen.clear()
            texts = [" ".join(rng.integers(0, 10**6, 50).astype(str)) for _ in range(n)]
            scores = lmscore.backoff_scores(make([(i, t, "a") for i, t in enumerate(texts)]))
            assert len(scores.collect()) == n
            rows[most_cuts, n] = sum(seen)
            if len(seen) > 1:
                assert "ReusedExchange" in scores._jdf.queryExecution().executedPlan().toString()
    assert rows[1_000, 600] > 10 * rows[1_000, 150]
    for n in (150, 600):
        blocks, levels = n * 50 // 400 + 8, 2
        assert rows[8, n] <= 3 * 8 * blocks * levels
    assert rows[8, 600] < rows[1_000, 600] / 2


@pytest.mark.parametrize("repeats", [35_000])
def test_a_megabyte_of_near_notices(repeats):
    """Searches are bounded by the notice, so time grows with the text: repeated lines, and lines edited one by one."""
    import time
    scanner, rng = licenses.Scanner(), np.random.default_rng(1)
    began = time.perf_counter()
    out = licenses.scan_text(b"licensed undr the mit license\n" * repeats, scanner)
    assert len(out["spans"]) == repeats == out["n_base"] and (out["first_word"], out["last_word"]) == (3, 5 * repeats - 2)
    notices = list(licenses.NOTICES)
    edits = [min(i % 4, licenses.max_edits(notices[i % len(notices)])) for i in range(repeats // 2)]
    lines = [edited(notices[i % len(notices)], n, rng) for i, n in enumerate(edits)]
    out = licenses.scan_text("\n".join(lines).encode(), scanner)
    assert len(out["spans"]) >= len(lines) * 0.99
    assert time.perf_counter() - began < 60


def test_errors_grow_with_the_notice():
    notice = "redistribution and use in source and binary forms with or without modification are permitted"
    text = notice.replace("source", "sorce").replace("binary", "binray").replace("permitted", "permited").replace("with or", "wiht or")
    assert licenses.max_edits(notice) == 7
    assert "bsd" in licenses.scan_text(text.encode(), licenses.Scanner())["labels"].split(",")
    assert licenses.scan_text(text.encode(), licenses.Scanner(chars_per_edit=40))["labels"] == ""


def test_training_takes_long_and_repeated_documents_in_their_turn(spark):
    """Documents beyond the size take no places of the sample, and a repeated id is always learnt from the same text."""
    from pyspark.sql import functions as F
    rows = [(i, "long " * 50, "a") for i in range(40)] + [(i, "short one", "a") for i in range(100, 110)]
    rows += [(100, "other text", "a"), (100, "other text", "a"), (None, "no id", "a"), (103, None, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    labels = spark.createDataFrame([(i, 1) for i, _, _ in rows if i is not None] + [(105, None)], "doc_id long, toxic int")
    taken = toxicity.training_sample(docs, labels, 4, 4, chars=20).collect()
    outside = [r[0] for r in docs.filter(toxicity.held_out(F.col("doc_id")) & (F.col("doc_id") >= 100)).select("doc_id").distinct().collect()]
    assert len(taken) == min(4, 10 - len(outside)) and all(r.doc_id >= 100 for r in taken)
    again = toxicity.training_sample(docs.orderBy(F.rand(3)).repartition(7), labels, 4, 4, chars=20).collect()
    assert sorted(map(tuple, taken)) == sorted(map(tuple, again))

"""The registered queries: against their SQL, and the pipeline against its operators."""

import os
import sys
from collections import Counter

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute  # noqa: E402
import corpus_pipeline  # noqa: E402
from oracle_compare import run  # noqa: E402

from urbanlake.llm.queries import ORACLE, QUERIES  # noqa: E402
from urbanlake.session import read_table  # noqa: E402

SMALL = os.environ.get("URBANLAKE_TEST_SF", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    out = run(spark, name, SMALL, QUERIES, ORACLE)
    assert out["cols_match"] and out["values_match"], out.get("examples")


def test_all_are_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert numbers == list(range(1, 14))


@pytest.mark.parametrize("sf,miss", [("0.001", 0.03), ("0.01", 0.01)])
def test_mixing_is_the_plain_fill(spark, sf, miss):
    """Every document as often as a plain fill takes it, every source near its target, each shard its share of draws."""
    base = f"/root/testdata/sf{sf}"
    docs = read_table(spark, base, "documents").select("doc_id", "source", "text").collect()
    got = {r.doc_id: r for r in QUERIES["op7_source_mixing"](spark, base).collect()}
    assert len(got) == len(docs)
    of = {}
    for d in docs:
        of.setdefault(d.source, []).append((d.doc_id, len(brute.WORD.findall(d.text or ""))))
    want = brute.targets({s: sum(n for _, n in rows) for s, rows in of.items()})
    shards = Counter()
    for s, rows in of.items():
        times = brute.class_fill(rows, want[s])
        words = 0
        for (i, n), k in zip(rows, times, strict=True):
            r = got[i]
            drawn = [int(x) for x in r.shards.split(",") if x]
            assert (r.size, r.taken, len(drawn)) == (n, k * n, k), (s, i)
            assert abs(r.target - want[s]) < 1e-6 * max(want[s], 1)
            words += r.taken
            shards.update(drawn)
        assert abs(words - want[s]) <= miss * want[s], (s, words, want[s])
    every = sum(shards.values())
    assert max(shards.values()) < 3 * every / len(shards) + 20 and len(shards) == int(spark.conf.get("spark.sql.shuffle.partitions"))


def rows_of(spark, name, table):
    """The query's rows and the table's, both by their id."""
    out = QUERIES[name](spark, SMALL).collect()
    given = read_table(spark, SMALL, table).collect()
    key = "page_id" if table == "pages" else "doc_id"
    by_id = {r[key]: r for r in out}
    assert len(out) == len(given) == len(by_id)
    return by_id, given


def test_op3_query(spark):
    got, docs = rows_of(spark, "op3_simhash_near_dedup", "documents")
    prints = [brute.simhash(d.text) for d in docs]
    roots = brute.components(len(docs), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 3)
    groups = {}
    for d, r in zip(docs, roots, strict=True):
        groups.setdefault(r, []).append(d.doc_id)
    for d, p, r in zip(docs, prints, roots, strict=True):
        g = got[d.doc_id]
        assert (g.fingerprint, g.component_id, g.kept) == (f"{p:016x}", min(groups[r]), d.doc_id == min(groups[r]))


def test_op4_query(spark):
    got, docs = rows_of(spark, "op4_quality_rules", "documents")
    labels = {r.doc_id: r.quality for r in read_table(spark, SMALL, "labels").collect()}
    for d in docs:
        g = got[d.doc_id]
        base = brute.base_quality(d.text)
        assert (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words) == base
        assert g.base_failed == (base[0] < 20 or 100 * base[4] > 30 * base[0])
        assert not (g.base_failed and g.kept)
    judged = [got[i] for i, q in labels.items() if q == 0 and i in got and not got[i].base_failed]
    assert sum(r.kept for r in judged) <= len(judged) / 2


def test_op5_query(spark):
    from urbanlake.llm import licenses
    got, docs = rows_of(spark, "op5_license_scan", "documents")
    for d in docs:
        g = got[d.doc_id]
        assert (g.n_words, g.n_base, g.first_word, g.last_word, g.base_labels) == brute.phrases(d.text, licenses.PHRASES)
        assert set(filter(None, g.base_labels.split(","))) <= set(g.labels.split(",")) and 0 <= g.score <= 1


def test_op6_query(spark):
    import base64
    import hashlib
    got, pages = rows_of(spark, "op6_warc_round_trip", "pages")
    last = {}
    for r in pages:
        last[r.html or ""] = max(last.get(r.html or "", r.page_id), r.page_id)
    for r in pages:
        body, g = (r.html or "").encode(), got[r.page_id]
        first = last[r.html or ""] == r.page_id
        assert (g.payload_bytes, g.payload_digest) == (len(body), base64.b32encode(hashlib.sha1(body).digest()).decode())
        assert (g.record_type, g.refers_to) == (("response", None) if first else ("revisit", last[r.html or ""]))


def test_op8_query(spark):
    import zlib
    got, docs = rows_of(spark, "op8_toxicity", "documents")
    assert all(g.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= g.score <= 1
               and g.predicted == int(g.score >= 0.5) for i, g in got.items())
    told = [(got[r.doc_id], r.toxic) for r in read_table(spark, SMALL, "labels").collect() if r.doc_id in got and r.toxic is not None]
    held = [(g.predicted, t) for g, t in told if g.held_out]
    assert sum(p == t for p, t in held) >= 0.85 * len(held)


def test_op9_and_op10_queries(spark):
    import zlib

    import numpy as np
    import sentencepiece
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(corpus_pipeline.vocabulary("word_bpe_49k.json"))
    library = sentencepiece.SentencePieceProcessor(model_file=corpus_pipeline.vocabulary("piece_bpe_32k.model"))
    crc = lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())
    files, docs = rows_of(spark, "op9_token_files", "documents")
    coded, _ = rows_of(spark, "op10_sentencepiece", "documents")
    start = 0
    for d in sorted(docs, key=lambda d: d.doc_id):
        ids = tokenizer.encode(d.text or "", add_special_tokens=False).ids + [2]
        assert (files[d.doc_id].start, files[d.doc_id].n_tokens, files[d.doc_id].ids_crc32) == (start, len(ids), crc(ids))
        start += len(ids)
        ids = library.encode(d.text or "")
        assert (coded[d.doc_id].n_pieces, coded[d.doc_id].ids_crc32, coded[d.doc_id].round_trip) == (len(ids), crc(ids), True)


def test_pipeline_stages(spark):
    from urbanlake.llm import pieces, quality, simhash, toxicity
    from urbanlake.llm.common import saved
    docs = read_table(spark, SMALL, "documents")
    labels = read_table(spark, SMALL, "labels")
    steps = []
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = saved(stage(spark, docs, SMALL), "test-stage")
        steps.append((name, before, docs))
        if name != "sentencepiece":
            assert docs.columns == before.columns
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    raw, clean = steps[0][1:]
    assert ids(clean) == sorted(r.doc_id for r in toxicity.toxicity(raw, labels).collect() if r.score < 0.5)
    assert ids(steps[1][2]) == sorted(r.doc_id for r in quality.quality_rules(clean, labels).collect() if r.kept)
    assert ids(steps[2][2]) == sorted(r.doc_id for r in simhash.near_duplicates(steps[2][1]).collect() if r.kept)
    of = {}
    for d in steps[3][1].select("doc_id", "source", "text").collect():
        of.setdefault(d.source, []).append((d.doc_id, len(brute.WORD.findall(d.text or ""))))
    want = brute.targets({s: sum(n for _, n in rows) for s, rows in of.items()})
    drawn = [i for s, rows in of.items() for (i, _), k in zip(rows, brute.class_fill(rows, want[s]), strict=True) for _ in range(k)]
    assert ids(steps[3][2]) == sorted(drawn)
    model = corpus_pipeline.vocabulary("piece_bpe_32k.model")
    text = {r.doc_id: r.text for r in steps[4][1].collect()}
    assert all(r.text == text[r.doc_id].replace("▁", " ") for r in pieces.decode_documents(steps[4][2], model).collect())
    assert corpus_pipeline.run(spark, SMALL).count() == steps[4][2].count()

"""Archives, token files and piece encoding: exact round trips."""

import base64
import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from brute import ODD
from llm_fixtures import make  # noqa: F401
from pyspark.sql import functions as F

from urbanlake.llm import pieces, tokenfile, warc

VOCABULARY, MODEL = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("piece_bpe_32k.model")
PAGES = "page_id long, url string, html string"


def test_loser_tree_merges_sorted_runs():
    rng = np.random.default_rng(0)
    for k in (0, 1, 2, 3, 5, 8, 17):
        runs = [sorted(rng.integers(0, 20, rng.integers(0, 12)).tolist()) for _ in range(k)]
        out = [runs[r][i] for r, i in warc.LoserTree(runs)]
        assert out == sorted(x for r in runs for x in r)
        assert [x for x in warc.LoserTree([[1], [1], [1]])] == [(0, 0), (1, 0), (2, 0)]


def brute_pages(rows):
    latest = {}
    for i, _, h in rows:
        if i is not None:
            latest[h or ""] = max(latest.get(h or "", i), i)
    out = []
    for i, _, h in rows:
        b, top = (h or "").encode(), latest.get(h or "")
        first = top is None or i == top
        out.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "response" if first else "revisit", None if first else top))
    return sorted(out, key=str)


def test_archives_round_trip(spark):
    rows = [(i, f"https://www.site{i % 7}.org:80/p/{i % 3}?q=é x#frag", f"<p>text {i % 20}</p>\r\n\r\nWARC/1.0 ü") for i in range(120)]
    rows += [(500, None, None), (501, "", ""), (502, "not a url\r\nX: y", "WARC/1.0\r\n\r\n"), (None, "http://a.b/", "<p>text 1</p>"),
             (None, "http://a.b/", "alone"), (503, "http://a.b/", "long " * 200_000), (503, "http://a.b/", "long " * 200_000)]
    pages = spark.createDataFrame(rows, PAGES).withColumn("sha1", F.lit("x")).withColumn("file", F.lit(1))
    got = warc.archive_round_trip(pages, file_bytes=4000).collect()
    fields = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r[f] for f in fields) for r in got), key=str) == brute_pages(rows)
    got.sort(key=lambda r: r.position)
    assert [r.position for r in got] == list(range(len(rows)))
    keys = [(r.urlkey, r.captured, -1 if r.page_id is None else r.page_id) for r in got]
    assert keys == sorted(keys)


def test_small_payloads_are_all_responses(spark):
    pages = spark.createDataFrame([(1, "http://a/", "same"), (2, "http://a/", "same"), (3, "http://b/", "longer"), (4, "http://b/", "longer")], PAGES)
    got = {r.page_id: r.record_type for r in warc.archive_round_trip(pages, min_bytes=5).collect()}
    assert got == {1: "response", 2: "response", 3: "revisit", 4: "response"}


def test_only_responses_carry_payloads(spark):
    rows = [(i, f"http://h/{i}", "blank" if i % 3 else f"page {i}") for i in range(90)]
    got = warc.captures(spark.createDataFrame(rows, PAGES)).collect()
    assert len(got) == 90 and sum(r.payload is not None for r in got) == 31
    assert {r.refers_to for r in got if r.payload is None} == {89}
    assert {r.payload.decode() for r in got if r.payload is not None} == {h for _, _, h in rows}


def test_index_merged_by_more_ranges_than_partitions(spark, monkeypatch):
    monkeypatch.setattr(warc, "RANGE_ENTRIES", 3)
    monkeypatch.setattr(warc, "READ_BYTES", 100)
    pages = spark.createDataFrame([(i, "http://one/", f"page {i % 50}") for i in range(100)], PAGES)
    got = sorted(warc.archive_round_trip(pages, file_bytes=500).collect(), key=lambda r: r.position)
    assert [r.position for r in got] == list(range(100)) and [r.page_id for r in got] == list(range(100))


def test_no_pages(spark):
    assert warc.archive_round_trip(spark.createDataFrame([], PAGES)).count() == 0


@pytest.mark.parametrize("n", [0, 1, 127, 128, 129, 4000])
@pytest.mark.parametrize("high", [1, 2, 300, 50_000, 2**32 - 1])
def test_blocks_round_trip(n, high):
    ids = np.random.default_rng(n).integers(0, high, n, dtype=np.uint32) if high > 1 else np.full(n, 7, np.uint32)
    ids[::50] = 2**32 - 1
    p = tokenfile.pack(ids)
    assert (tokenfile.unpack(p["low"], p["width"], p["outside"], p["start"], p["packed"], p["place"], p["value"], n) == ids).all()
    docs, lengths, back = tokenfile.read_file(tokenfile.file_bytes([None, 5], np.array([n, 0]), ids))
    assert docs == [None, 5] and lengths.tolist() == [n, 0] and (back == ids).all()


TEXTS = ["", "  a\tb c\u0085d\x1ce Σας ΣΑΣ é ́x <|endoftext|>foo don't I'll", "'s 're\n's 12345 !!!'ll", "ᄀ ᅡ가 日本語 😀",
         "x" * 3000, "a  b   c    d", "▁marks▁ ▁", "\n\n \n", "Straße naïve"]


def test_token_files_match_whole_text_encoding(spark, make):
    from tokenizers import Tokenizer
    rows = [(i, t, "a") for i, t in ODD_IDS] + [(100 - i, t, "a") for i, t in enumerate(TEXTS)]
    tokenizer = Tokenizer.from_file(VOCABULARY)
    order = sorted(rows, key=lambda r: -1 if r[0] is None else r[0])
    want, start = [], 0
    for i, t, _ in order:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [2]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    for file_ids in (1, 10_000_000):
        got = tokenfile.token_files(make(rows).repartition(4), VOCABULARY, file_ids=file_ids).collect()
        assert sorted((tuple(r) for r in got), key=str) == sorted(want, key=str)


ODD_IDS = [(i, t) for i, t, _ in ODD]


def test_no_token_files(make):
    assert tokenfile.token_files(make([(1, "x", "a")]).limit(0), VOCABULARY).count() == 0


def test_pieces_are_the_librarys(spark, make):
    import sentencepiece
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rng = np.random.default_rng(8)
    texts = [*TEXTS, *("".join(rng.choice(list("the nadio."), rng.integers(1, 60))) for _ in range(60)),
             *("".join(rng.choice(list("a b\n"), rng.integers(1, 30))) for _ in range(40))]
    rows = ODD + [(1000 + i, t, "a") for i, t in enumerate(texts)]
    encoded = pieces.encode_documents(make(rows), MODEL)
    got = encoded.collect()
    assert sorted((str(r.doc_id), r.ids) for r in got) == sorted((str(i), library.encode(t or "")) for i, t, _ in rows)
    assert all(r.round_trip for r in got)
    back = {r.doc_id: r.text for r in pieces.decode_documents(encoded, MODEL).collect()}
    assert all(back[i] == (t or "").replace("▁", " ") for i, t, _ in rows)
    for r in pieces.digests(encoded).collect():
        assert r.n_pieces == len(next(x.ids for x in got if x.doc_id == r.doc_id))


def test_runs_of_a_tokenizers_borders():
    """Cut texts encode as whole ones, whatever signs, digits and apostrophes meet."""
    import pyarrow as pa
    from tokenizers import Tokenizer
    tokenizer, rng = Tokenizer.from_file(VOCABULARY), np.random.default_rng(4)
    letters = [*"abstrevmld", *"'" * 4, *".,!-12 9\n\t ́éßA’"]
    texts = ["".join(rng.choice(letters, rng.integers(0, 40))) for _ in range(1500)]
    texts += ["o'clock 'tis l'été a's!'s '!s x1y2 3.4, 5. a.b,c ...", "<|x a.b 1c", "", " "]
    with open(VOCABULARY, encoding="utf-8") as f:
        encoder = tokenfile.Encoder(f.read())
    ids, counts = encoder.encode(pa.array([t.encode() for t in texts], pa.binary()))
    for t, part in zip(texts, np.split(ids, np.cumsum(counts)[:-1]), strict=True):
        assert part.tolist() == tokenizer.encode(t, add_special_tokens=False).ids, repr(t)


def test_other_tokenizers_are_refused():
    import json
    with open(VOCABULARY, encoding="utf-8") as f:
        rules = json.load(f)
    rules["normalizer"] = None
    with pytest.raises(ValueError):
        tokenfile.Encoder(json.dumps(rules))


@pytest.mark.parametrize("unit", ["x", "ab", "andthenoinerst", "日本語漢字東京都", None])
def test_long_words_without_blanks(unit):
    """A megabyte in one word, by windows; each takes seconds."""
    import time

    import sentencepiece
    rng = np.random.default_rng(2)
    text = unit * (10**6 // len(unit)) if unit else "".join(rng.choice(list("etaoinshrdlu"), 10**6))
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    model = pieces.Pieces.load(MODEL)
    began = time.perf_counter()
    parts, counts = pieces.parts_of(model, [text])
    ids, _ = pieces.RaggedCache(model.segment).gather(parts, counts)
    assert time.perf_counter() - began < 20
    assert ids.tolist() == library.encode(text)


def test_words_whose_windows_share_no_border_go_whole():
    strings = ["<unk>", "a", "b", "aa", "aaaa"]
    model = pieces.Pieces(strings, [0.0, -5.0, -6.0, -1.0, -2.0], [], {0}, merges=True)
    for n in (pieces.LONG + 1, pieces.LONG + 7, 9001):
        flat, sizes = model.segment(["a" * n])
        assert flat.tolist() == [4] * (n // 4) + [3] * (n % 4 // 2) + [1] * (n % 2) and sizes.tolist() == [len(flat)]


def test_unigram_scores_take_the_best_sum():
    strings = ["<unk>", "a", "b", "ab", "abc", "c", "bc"]
    scores = [0.0, -2.0, -3.0, -4.0, -9.5, -3.5, -5.0]
    model = pieces.Pieces(strings, scores, [], {0}, merges=False)
    flat, sizes = model.segment(["abc", "ab", "cab", "a"])
    assert np.split(flat, np.cumsum(sizes)[:-1])[0].tolist() == [1, 6]          # -7 beats -7.5 and -9.5
    assert [x.tolist() for x in np.split(flat, np.cumsum(sizes)[:-1])][1:] == [[3], [5, 3], [1]]


def test_no_pieces(make):
    assert pieces.digests(pieces.encode_documents(make([(1, "x", "a")]).limit(0), MODEL)).count() == 0

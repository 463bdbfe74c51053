"""SentencePiece encoding and decoding by batched Viterbi.

A text is normalised as the model says (a leading space mark, blanks as space
marks) and cut where no piece can reach across: before a run of space marks,
around line ends, and between characters that are neighbours in no piece.  The
distinct words of a batch are grouped by length, and the words of a group
advance together, one character a step: hashes of the substrings that end there,
of every length that pieces have, probe the sorted hashes of the pieces, and the
best of the paths that they extend is kept with the length of its last piece as
back-pointer.  In a merge model a word of thousands of characters goes as
overlapping windows that advance together.

In a unigram model a path scores the sum of its pieces' scores; equal sums go
to the longer last piece, and a character that no piece covers costs ten below
the lowest score.  In a merge model the scores are only ranks, and adding them
up gives other pieces than the model's.  There a path scores by its steps: two
neighbours stand next to each other in the model's encoding if and only if no
merge across their border comes before the merges that make them, which is
looked up by undoing those merges from the last one; a step that fails ends the
path.  Exactly one path lasts, and it is the encoding by merges.

A character outside the pieces is encoded as its UTF-8 bytes.  Decoding gives
back the text: every document says whether it did.  Words are independent and
each document is encoded by itself, so nothing is shuffled; a task's cache of
words is bounded.  Defined cases: a null or empty text has no id; U+2581 in a
text is a space mark, as the format defines, and so decodes to a blank;
repeated rows are encoded each.
"""

from __future__ import annotations

import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from urbanlake.llm.common import RaggedCache, batches, by_bytes, text_bytes

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
BASE = np.uint64(0x9E3779B97F4A7C15)
#: A word of more characters goes by windows that start at multiples of a stride and reach ``OVERLAP`` characters further.
LONG, OVERLAP, STRIDES = 4096, 256, (1680, 1683, 1690)


class Pieces:
    """The pieces of a model: strings, scores, and the ids of the byte pieces."""

    def __init__(self, strings: list[str], scores: list[float], byte_ids: list[int], skipped: set[int], merges: bool) -> None:
        self.byte_ids, self.merges = byte_ids, merges
        usable = [i for i in range(len(strings)) if i not in skipped]
        keys = np.array([self._key(strings[i]) for i in usable], dtype=np.uint64)
        order = np.argsort(keys)
        self.keys = keys[order]                                  # everything below is in this order
        self.maybe = np.zeros(1 << 20, dtype=bool)               # by a hash's first 20 bits: whether a piece has them
        self.maybe[self.keys >> np.uint64(44)] = True
        if (self.keys[1:] == self.keys[:-1]).any():
            raise ValueError("two pieces share a hash")
        self.ids = np.array(usable, dtype=np.int32)[order]
        self.scores = np.array([scores[i] for i in usable], dtype=np.float64)[order]
        self.size = np.array([len(strings[i]) for i in usable], dtype=np.int64)[order]
        self.longest = int(self.size.max())
        self.power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(self.longest, BASE)]), dtype=np.uint64)
        self.unknown = float(self.scores.min()) - UNKNOWN_PENALTY
        self.utf8 = [s.encode() for s in strings]
        for byte, i in enumerate(byte_ids):
            self.utf8[i] = bytes([byte])
        longer = [strings[i] for i in usable if len(strings[i]) > 1]
        chars = sorted(set("".join(longer)))
        self.char_no = np.zeros(sys.maxunicode + 1, dtype=np.uint16)     # 0: in no piece beside another character
        self.char_no[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        self.joined = np.zeros((len(chars) + 1, len(chars) + 1), dtype=bool)
        for s in longer:
            at = self.char_no[[ord(c) for c in s]]
            self.joined[at[:-1], at[1:]] = True
        if merges:
            self._undo_merges([strings[i] for i in self.ids])

    @classmethod
    def load(cls, model_path: str) -> Pieces:
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        with open(model_path, "rb") as f:
            proto.ParseFromString(f.read())
        sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
        every = range(sp.get_piece_size())
        strings = [sp.id_to_piece(i) for i in every]
        return cls(strings, [sp.get_score(i) for i in every], [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)],
                   {i for i in every if sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)},
                   proto.trainer_spec.model_type == sentencepiece_model_pb2.TrainerSpec.BPE)

    @classmethod
    def restore(cls, state: dict) -> Pieces:
        """From ``vars()`` of another one: plain values travel to tasks without this class."""
        model = cls.__new__(cls)
        model.__dict__.update(state)
        return model

    @staticmethod
    def _key(piece: str) -> int:
        h = 0
        for c in piece:
            h = (h * int(BASE) + ord(c) + 1) % (1 << 64)
        return h

    def _find(self, h: np.ndarray) -> np.ndarray:
        """Places of hashes among the pieces, -1 for others."""
        out = np.full(h.shape, -1, dtype=np.int64)
        hit = self.maybe[h >> np.uint64(44)]
        some = h[hit]
        at = np.minimum(np.searchsorted(self.keys, some), len(self.keys) - 1)
        out[hit] = np.where(self.keys[at] == some, at, -1)
        return out

    def _undo_merges(self, strings: list[str]) -> None:
        """Ranks of the pieces in merge order and, for each, the two pieces of its last merge.

        Single characters come first and are their own halves.  Shorter pieces
        are done before longer ones; of all ways to cut a piece in two, that one
        is its last merge whose halves stay neighbours until then.
        """
        n = len(self.keys)
        self.rank = np.empty(n, dtype=np.int64)
        self.rank[np.lexsort((self.ids, -self.scores, self.size > 1))] = np.arange(n)
        self.left = np.arange(n)
        self.right = np.arange(n)
        self.made = self.size == 1                               # pieces that merges can make
        for size in range(2, self.longest + 1):
            group = np.flatnonzero(self.size == size)
            for cut in range(1, size):
                a = self._find(np.array([self._key(strings[p][:cut]) for p in group], dtype=np.uint64))
                b = self._find(np.array([self._key(strings[p][cut:]) for p in group], dtype=np.uint64))
                fits = (a >= 0) & (b >= 0) & self.made[a] & self.made[b]
                fits &= (self.rank[a] < self.rank[group]) & (self.rank[b] < self.rank[group])
                p, a, b = group[fits], a[fits], b[fits]
                fits = self._neighbours(a, b, self.rank[p])
                self.left[p[fits]], self.right[p[fits]] = a[fits], b[fits]
                self.made[p[fits]] = True

    def _neighbours(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """Whether pieces a and b stay two neighbours while all merges below rank ``limit`` are done.

        Looks at the border while the merges that made the pieces are undone
        from the last one: if at some time the two pieces at the border could
        merge before that merge, they would have.  Of equal ranks the left one
        comes first.
        """
        a, b, limit = a.copy(), b.copy(), limit.copy()
        good = np.ones(len(a), dtype=bool)
        live = np.arange(len(a))
        while len(live):
            x, y = a[live], b[live]
            joined = self._find(self.keys[x] * self.power[self.size[y]] + self.keys[y])
            across = np.where((joined >= 0) & (self.size[x] + self.size[y] <= self.longest), self.rank[joined], np.iinfo(np.int64).max)
            broken = across < limit[live]
            good[live[broken]] = False
            inner_x, inner_y = self.size[x] > 1, self.size[y] > 1
            undo_x = inner_x & (~inner_y | (self.rank[x] > self.rank[y]))
            undo_y = inner_y & ~undo_x
            limit[live] = np.where(undo_x, self.rank[x], np.where(undo_y, self.rank[y] + 1, 0))
            a[live] = np.where(undo_x, self.right[x], x)
            b[live] = np.where(undo_y, self.left[y], y)
            live = live[~broken & (undo_x | undo_y)]
        return good

    def _steps(self, last: np.ndarray, found: np.ndarray) -> np.ndarray:
        """0 where a found piece may follow the last one, else minus infinity.

        Only one piece can end at a place, so where the longest one found may
        follow, the shorter ones are not looked at.
        """
        rows, out = np.arange(len(found)), np.full(found.shape, -np.inf)
        longest = (found >= 0).argmax(axis=1)
        sure = (found[rows, longest] >= 0) & self._follow(last[rows, longest], found[rows, longest])
        out[rows[sure], longest[sure]] = 0.0
        open_ = (found >= 0) & ~sure[:, None]
        open_[rows, longest] = False
        r, c = np.nonzero(open_)
        out[r, c] = np.where(self._follow(last[r, c], found[r, c]), 0.0, -np.inf)
        return out

    def _follow(self, last: np.ndarray, found: np.ndarray) -> np.ndarray:
        """Whether each found piece can be made and stays the neighbour of the last one."""
        fine = (found >= 0) & self.made[found]
        pair = np.flatnonzero(fine & (last >= 0))
        pairs, where = np.unique(last[pair] * len(self.keys) + found[pair], return_inverse=True)
        a, b = np.divmod(pairs, len(self.keys))
        fine[pair] = self._neighbours(a, b, np.full(len(a), np.iinfo(np.int64).max))[where]
        return fine

    def paths(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The best segmentations, one after the other, of words of the same length.

        Places of the pieces (-1: a character outside the pieces), their
        lengths, and how many pieces each word has.
        """
        n, size = len(words), len(words[0])
        chars = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4").reshape(n, size).astype(np.uint64)
        prefix = np.zeros((n, size + 1), dtype=np.uint64)
        for j in range(size):
            prefix[:, j + 1] = prefix[:, j] * BASE + chars[:, j] + np.uint64(1)
        reach = min(self.longest, size)
        score = np.full((n, size + 1), -np.inf)
        score[:, 0] = 0.0
        taken = np.zeros((n, size + 1), dtype=np.int64)        # length of the last piece
        last = np.full((n, size + 1), -1, dtype=np.int64)      # its place, -1: none or unknown
        rows = np.arange(n)
        for j in range(1, size + 1):
            lengths = np.arange(min(reach, j), 0, -1)          # the longest first: ties go to it
            starts = j - lengths
            found = self._find(prefix[:, j:j + 1] - prefix[:, starts] * self.power[lengths])
            if self.merges:
                gain = self._steps(last[:, starts], found)
                gain[:, -1] = np.where(found[:, -1] >= 0, gain[:, -1], 0.0)
            else:
                gain = np.where(found >= 0, self.scores[found], -np.inf)
                gain[:, -1] = np.where(found[:, -1] >= 0, gain[:, -1], self.unknown)
            total = score[:, starts] + gain
            choice = total.argmax(axis=1)
            score[:, j] = total[rows, choice]
            taken[:, j] = lengths[choice]
            last[:, j] = found[rows, choice]
        place = np.zeros((n, size), dtype=np.int64)            # pieces from the word's end
        span = np.zeros((n, size), dtype=np.int64)
        count, at, live, step = np.zeros(n, dtype=np.int64), np.full(n, size), rows, 0
        while len(live):
            here = at[live]
            place[live, size - 1 - step] = last[live, here]
            span[live, size - 1 - step] = taken[live, here]
            count[live] += 1
            at[live] = here - taken[live, here]
            live, step = live[at[live] > 0], step + 1
        inside = np.arange(size)[None, :] >= (size - count)[:, None]
        return place[inside], span[inside], count

    def _to_ids(self, words: list[str], place: np.ndarray, span: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces, a character outside them as its bytes, and how many each word has."""
        flat = np.where(place >= 0, self.ids[place], -1)
        if (place >= 0).all():
            return flat.astype(np.int32), count
        owner = np.repeat(np.arange(len(words)), count)
        before = np.cumsum(span) - span
        chars = "".join(words)                                 # words stand one after the other, as their pieces do
        each = [[x] if x >= 0 else [self.byte_ids[b] for b in chars[i].encode()]
                for x, i in zip(flat.tolist(), before.tolist(), strict=True)]
        sizes = np.bincount(owner, [len(x) for x in each], len(words)).astype(np.int64)
        return np.array([i for x in each for i in x], dtype=np.int32), sizes

    def best(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the best segmentations, one after the other, and their sizes; all words have the same length."""
        if self.merges and len(words[0]) > LONG:
            found = [self._long(w) for w in words]
            place, span = (np.concatenate([f[i] for f in found]) for i in (0, 1))
            return self._to_ids(words, place, span, np.array([len(f[0]) for f in found]))
        return self._to_ids(words, *self.paths(words))

    def _long(self, word: str) -> tuple[np.ndarray, np.ndarray]:
        """Places and lengths of a long word's pieces in a merge model.

        Overlapping windows advance together and are joined where two share a
        border whose pieces may stand next to each other.  Then every step of
        the joined path holds, and only the encoding is such a path.  Windows
        start at multiples of most piece lengths, so those of an endless repeat
        share borders too; if some don't for any stride, the word goes whole.
        """
        for stride in STRIDES:
            starts = list(range(0, max(1, len(word) - OVERLAP), stride))
            texts = [word[a:a + stride + OVERLAP] for a in starts[:-1]]
            found = []
            for at in range(0, len(texts), 256):
                place, span, count = self.paths(texts[at:at + 256])
                cuts = np.cumsum(count)[:-1]
                found += zip(np.split(place, cuts), np.split(span, cuts), strict=True)
            found.append(self.paths([word[starts[-1]:]])[:2])
            joined = self._join(starts, found)
            if joined is not None:
                return joined
        return self.paths([word])[:2]

    def _join(self, starts: list[int], found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray] | None:
        places, spans, begin = [], [], 0
        for k, (place, span) in enumerate(found):
            if k + 1 == len(found):
                places.append(place[begin:])
                spans.append(span[begin:])
                return np.concatenate(places), np.concatenate(spans)
            ends = starts[k] + np.cumsum(span)
            next_place, next_span = found[k + 1]
            heads = starts[k + 1] + np.cumsum(next_span) - next_span
            _, a, b = np.intersect1d(ends, heads, assume_unique=True, return_indices=True)
            a, b = a[a >= begin], b[a >= begin]
            left, right = place[a], next_place[b]
            fits = (left < 0) | (right < 0) | self._follow(left, np.maximum(right, 0))
            a, b = a[fits], b[fits]
            if not len(a):
                return None
            mid = len(a) // 2
            places.append(place[begin:a[mid] + 1])
            spans.append(span[begin:a[mid] + 1])
            begin = int(b[mid])
        return None

    def segment(self, words: list[str], cells: int = 1 << 18) -> tuple[np.ndarray, np.ndarray]:
        """Best segmentations of words of any lengths, in order; ``cells`` bounds a group's characters."""
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        order = np.argsort(lengths, kind="stable")
        flats, sizes, start = [], np.empty(len(words), dtype=np.int64), 0
        while start < len(order):
            size = int(lengths[order[start]])
            end = int(np.searchsorted(lengths[order], size, side="right"))
            end = min(end, start + max(1, cells // size))
            flat, sizes[start:end] = self.best([words[i] for i in order[start:end].tolist()])
            flats.append(flat)
            start = end
        flat = np.concatenate(flats) if flats else np.empty(0, np.int32)
        starts, back = np.cumsum(sizes) - sizes, np.argsort(order, kind="stable")
        ends = np.cumsum(sizes[back])
        total = int(ends[-1]) if len(ends) else 0
        return flat[np.repeat(starts[back] - (ends - sizes[back]), sizes[back]) + np.arange(total)], sizes[back]

    def decode(self, ids: list[int]) -> str:
        text = b"".join(map(self.utf8.__getitem__, ids)).decode("utf-8", "replace").replace(SPACE, " ")
        return text[1:] if text[:1] == " " else text


def parts_of(model: Pieces, texts: list[str]) -> tuple[pa.StringArray, np.ndarray]:
    """The parts of the normalised texts that no piece reaches across, and how many each text has.

    A cut is before a run of space marks, around line ends, and between two
    characters that stand side by side in no piece: no merge crosses it.
    """
    normal = [SPACE + t.replace(" ", SPACE) if t else "" for t in texts]
    sizes = np.fromiter(map(len, normal), dtype=np.int64, count=len(normal))
    first = np.cumsum(sizes) - sizes
    whole = "".join(normal)
    chars = np.frombuffer(whole.encode("utf-32-le"), dtype="<u4")
    number = model.char_no[chars]
    line, space = chars == 10, chars == ord(SPACE)
    cut = np.zeros(len(chars), dtype=bool)
    cut[1:] = ~model.joined[number[:-1], number[1:]] | line[1:] | line[:-1] | (space[1:] & ~space[:-1])
    cut[first[sizes > 0]] = True
    at = np.flatnonzero(cut)
    width = 1 + (chars >= 0x80) + (chars >= 0x800).astype(np.int64) + (chars >= 0x10000)
    upto = np.concatenate([[0], np.cumsum(width)])
    offsets = np.append(upto[at], upto[-1]).astype(np.int32)
    parts = pa.Array.from_buffers(pa.string(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(whole.encode())])
    return parts, np.diff(np.searchsorted(at, np.append(first, len(chars))))


def encode_documents(docs: DataFrame, model_path: str) -> DataFrame:
    """``doc_id, ids array<int>, round_trip``: piece ids and whether they decode to the text."""
    # a vocabulary, of fixed size; a worker keeps the value, and with it the cache of words, from task to task
    shared = docs.sparkSession.sparkContext.broadcast({"pieces": vars(Pieces.load(model_path))})

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Pieces.restore(shared.value["pieces"])
        cache = shared.value.setdefault("cache", RaggedCache(model.segment))
        for b in by_bytes(rows, "utf8"):
            texts = [t.decode("utf-8", "replace") for t in b.column("utf8").to_pylist()]
            ids, counts = cache.gather(*parts_of(model, texts))
            ends = np.concatenate([[0], np.cumsum(counts)])
            same = [model.decode(ids[a:z].tolist()) == t.replace(SPACE, " ")
                    for a, z, t in zip(ends, ends[1:], texts, strict=False)]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids)), pa.array(same)],
                ["doc_id", "ids", "round_trip"])

    return text_bytes(docs).mapInArrow(run, "doc_id long, ids array<int>, round_trip boolean")


def decode_documents(encoded: DataFrame, model_path: str) -> DataFrame:
    """``doc_id, text`` from ``doc_id, ids``; null ids decode to an empty text."""
    shared = encoded.sparkSession.sparkContext.broadcast(vars(Pieces.load(model_path)))

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Pieces.restore(shared.value)
        for b in batches(rows):
            texts = [model.decode(x or []) for x in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def digests(encoded: DataFrame) -> DataFrame:
    """``doc_id, n_pieces, ids_crc32, round_trip``: the ids as a checksum of their little-endian 32-bit bytes."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows:
            lists = b.column("ids")
            ids = lists.flatten().to_numpy(zero_copy_only=False).astype("<u4")
            sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            ends = np.concatenate([[0], np.cumsum(sizes)])
            data = memoryview(ids.tobytes())
            crc = [zlib.crc32(data[4 * int(a):4 * int(z)]) for a, z in zip(ends, ends[1:], strict=False)]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(sizes.astype(np.int64)), pa.array(crc, pa.int64()), b.column("round_trip")],
                ["doc_id", "n_pieces", "ids_crc32", "round_trip"])

    return encoded.mapInArrow(run, "doc_id long, n_pieces long, ids_crc32 long, round_trip boolean")

"""Best-fit packing: documents into sequences of at most ``capacity`` tokens.

Bounded-space online best fit. A task keeps a fixed number of open bins in a bit
set keyed by free space: the lowest set bit at or above a piece's length is the
bin it fits best, one shift and one mask away. When a bin must open and no place
is left, the fullest closes. The pieces of bins still open at a task's end go on
to a second round of the same algorithm, longest first, so that tasks do not each
leave a tail.

Tokens come from a given tokenizer file. A group of texts is cut at once where the
tokenizer cuts: at white space, which always ends a word there, and into runs of
letters, digits and runs of other characters. The group's distinct parts are looked
up among those that a worker remembers, and the tokenizer sees only new ones.
"""

from __future__ import annotations

import json
import os
import re
import string
import unicodedata
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from riskloom.llm.common import doc_columns, read, stored, text_blocks, texts, worker_memory

CAPACITY = 2048
OPEN_BINS = 1024
END_ID = 0
TOKENIZER = "word_bpe_49k.json"
#: Leftover pieces of the first round that share a task of the second, and that task's open bins.
SECOND_ROUND = 50_000
#: Bytes of parts of words that a worker keeps; what an entry takes beside its letters and ids.
WORD_BYTES, _ENTRY = 160 << 20, 160
#: New parts of words that are encoded in one line; bytes of text whose parts are looked up together, beyond which a
#: text is taken block by block.
TOGETHER, GROUP = 2_000, 2 << 20

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, bin long, offset long, fill long, open boolean"
#: How the tokenizer cuts a text, and the same for a word in lower case whose characters beyond ASCII are letters.
_CUT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_WORD_CUT = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|[a-z\x80-\xFF]+|[0-9]|[!-/:-@\[-`{-~]+")
_WHITE = b" \t\n\v\f\r"
_SPACE, _LETTER, _DIGIT, _SIGN, _ODD = range(5)
#: Characters of two bytes that are taken for letters, and what makes a word odd among them: those that are none, do
#: not stay as they are in NFC or one letter in lower case, and the beginning of a special token.
_TWO_BYTES = [chr(c) for c in [*range(0xC0, 0x2C0), *range(0x380, 0x500)]]
_ODD_PAIRS = [c.encode() for c in _TWO_BYTES if not ((c + c.lower()).isalpha() and unicodedata.is_normalized("NFC", c))] + [b"<|"]


def _kinds() -> bytes:
    kinds = bytearray([_ODD]) * 256
    for of, kind in (
        (_WHITE, _SPACE),
        (string.ascii_letters.encode() + bytes(range(0x80, 0xC0)) + bytes(c.encode()[0] for c in _TWO_BYTES), _LETTER),
        (string.digits.encode(), _DIGIT),
        (string.punctuation.encode(), _SIGN),
    ):
        for byte in of:
            kinds[byte] = kind
    return bytes(kinds)


_KINDS = _kinds()


class Bins:
    """Open bins by free space. ``give`` places an item and yields the bins that close."""

    def __init__(self, capacity: int, most: int):
        self.capacity, self.most, self.held, self.mask = capacity, most, 0, 0
        self.by_free: list[list[tuple[int, list]]] = [[] for _ in range(capacity + 1)]
        self.count = 0

    def _take(self, free: int) -> tuple[int, list]:
        stack = self.by_free[free]
        taken = stack.pop()
        if not stack:
            self.mask &= ~(1 << free)
        self.held -= 1
        return taken

    def give(self, size: int, item) -> Iterator[tuple[int, int, list]]:
        """Closed bins as (number, fill, [(offset, item)])."""
        fits = self.mask >> size
        if fits:
            free = size + (fits & -fits).bit_length() - 1
            number, items = self._take(free)
        else:
            if self.held == self.most:
                fullest = (self.mask & -self.mask).bit_length() - 1
                number, items = self._take(fullest)
                yield number, self.capacity - fullest, items
            free, number, items = self.capacity, self.count, []
            self.count += 1
        items.append((self.capacity - free, item))
        if free == size:
            yield number, self.capacity, items
            return
        self.by_free[free - size].append((number, items))
        self.mask |= 1 << (free - size)
        self.held += 1

    def rest(self) -> Iterator[tuple[int, int, list]]:
        for free, stack in enumerate(self.by_free):
            for number, items in stack:
                yield number, self.capacity - free, items


class Recent:
    """Ids by word in at most ``most`` bytes and what one group of texts adds: two halves, of which the older goes when
    the other is full. Words that are met again move to the newer one."""

    def __init__(self, most: int):
        self.most, self.held = most, 0
        self.ids: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def turn(self) -> None:
        if self.held > self.most // 2:
            self.ids, self.older, self.held = {}, self.ids, 0

    def missing(self, words: set[bytes]) -> set[bytes]:
        """Those of the words that are not known; the others are in ``ids`` now."""
        new = words.difference(self.ids)
        again = {w: self.older[w] for w in new if w in self.older}
        self.add(again)
        return new.difference(again)

    def add(self, found: dict[bytes, bytes]) -> None:
        self.ids.update(found)
        self.held += _ENTRY * len(found) + sum(map(len, found)) + sum(map(len, found.values()))


def _cut(text: bytes, cuts: bool) -> tuple[np.ndarray, pa.BinaryArray]:
    """The parts of a text that ends in three spaces, and where they begin. With ``cuts`` words are put into lower case
    and cut as the tokenizer does it, but for odd words, which may compose or hold unusual characters: those stay as
    they are. Else parts are words."""
    held = bytearray(text.lower() if cuts else text)
    at, kinds = np.frombuffer(held, np.uint8), np.frombuffer(held.translate(_KINDS), np.uint8)
    inside, before = kinds != _SPACE, np.empty_like(kinds)
    before[:1], before[1:] = _SPACE, kinds[:-1]
    words = inside & (before == _SPACE)
    begins = words
    if cuts:
        begins = inside & ((kinds != before) | (kinds == _DIGIT))
        marks = np.flatnonzero((at == ord("'")) & (before != _SIGN))
        one, two = at[marks + 1], at[marks + 2]
        size = np.where(np.isin(one, list(b"stmd")), 2, 0)
        for a, b in (b"re", b"ve", b"ll"):
            size[(one == a) & (two == b)] = 3
        marks, size = marks[size > 0], size[size > 0]
        begins[marks + 1] = False
        begins[marks + size] = inside[marks + size]
        odd = [np.flatnonzero(kinds == _ODD)]
        pairs = [p for p in _ODD_PAIRS if p[0] in text and p in text]
        odd += [np.array([m.start() for m in re.finditer(re.escape(p), text)], int) for p in pairs]
        odd = np.concatenate(odd)
        if len(odd):
            first, gaps = np.flatnonzero(words), np.flatnonzero(~inside)
            first = first[np.unique(np.searchsorted(first, odd, "right") - 1)]
            for a, b in zip(first.tolist(), gaps[np.searchsorted(gaps, first)].tolist(), strict=True):
                begins[a + 1 : b] = False
                held[a:b] = text[a:b]
    letters = bytes(held.translate(None, _WHITE))
    offsets = np.append(np.flatnonzero(begins[inside]), len(letters)).astype(np.int32)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(letters)]
    return np.flatnonzero(begins), pa.Array.from_buffers(pa.binary(), len(offsets) - 1, buffers)


def text_ids(spec: str) -> Callable[[list[bytes]], list[bytes]]:
    """Ids of texts, as little-endian unsigned 32-bit numbers."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    memory = worker_memory(f"packing-{zlib.crc32(spec.encode())}")
    if "tokenizer" not in memory:
        made = Tokenizer.from_str(spec)
        mark, ends = json.loads(spec)["model"].get("end_of_word_suffix"), None
        if mark:  # ids that end a part: parts can be encoded in one line and told apart again
            ends = np.zeros(made.get_vocab_size(), bool)
            ends[[i for piece, i in made.get_vocab().items() if piece.endswith(mark)]] = True
        steps = (json.loads(spec).get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        cuts = steps[0].get("pattern") == {"Regex": _CUT}
        memory.update(tokenizer=made, parts=Recent(WORD_BYTES), ends=ends, cuts=cuts)
    tokenizer, known, part_ends, cuts = (memory[k] for k in ("tokenizer", "parts", "ends", "cuts"))
    model = tokenizer.model

    def encoded(new: set[bytes]) -> dict[bytes, bytes]:
        """Ids of parts: of those of ASCII from the model itself, as there is nothing to cut or to change in them."""
        whole = [s for s in new if cuts and (s.isalpha() or s.isascii() and _WORD_CUT.fullmatch(s))]
        done = {s: array("I", [t.id for t in model.tokenize(s.decode("ascii"))]).tobytes() for s in whole}
        left = {s: s.decode("utf-8") for s in new if s not in done}
        letters = [s for s, t in left.items() if part_ends is not None and t.isalpha()]
        for i in range(0, len(letters), TOGETHER):
            some = letters[i : i + TOGETHER]
            line = tokenizer.encode_batch_fast([" ".join(left[s] for s in some)], add_special_tokens=False)[0].ids
            line = np.array(line, dtype="<u4")
            ends = 4 * (np.flatnonzero(part_ends[line]) + 1)
            if len(ends) == len(some):  # else some part is more than one to the tokenizer
                raw = line.tobytes()
                done.update((s, raw[a:b]) for s, a, b in zip(some, [0, *ends.tolist()], ends.tolist(), strict=False))
        rest = [(s, t) for s, t in left.items() if s not in done]
        coded = tokenizer.encode_batch_fast([t for _, t in rest], add_special_tokens=False) if rest else []
        done.update((s, np.array(e.ids, dtype="<u4").tobytes()) for (s, _), e in zip(rest, coded, strict=True))
        return done

    def ids(texts: list[bytes]) -> list[bytes]:
        begins, parts = _cut(b" ".join(texts) + b"   ", cuts)
        parts = parts.dictionary_encode()
        distinct, index = parts.dictionary.to_numpy(zero_copy_only=False).tolist(), parts.indices.to_numpy()
        known.turn()
        known.add(encoded(known.missing(set(distinct))))
        found = [known.ids[p] for p in distinct]
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        counts = sizes[index]
        ends = np.append(0, np.cumsum(counts))
        # the ids of a part stand together in ``joined``: those of all parts in order of the text
        joined, first = np.frombuffer(b"".join(found), dtype="<u4"), np.cumsum(sizes) - sizes
        raw = joined[np.repeat(first[index] - ends[:-1], counts) + np.arange(ends[-1])].tobytes()
        edges = np.append(0, np.cumsum([len(t) + 1 for t in texts], dtype=np.int64))
        cut = (4 * ends[np.searchsorted(begins, edges)]).tolist()
        return [raw[a:b] for a, b in zip(cut, cut[1:], strict=False)]

    return ids


def word_ids(spec: str) -> Callable[[list[list[bytes]]], list[bytes]]:
    """``text_ids`` of documents that are given as lists of words."""
    ids = text_ids(spec)
    return lambda lists: ids([b" ".join(words) for words in lists])


def token_ids(spark: SparkSession, tokenizer: str) -> Callable[[], Callable[[list[bytes]], list[bytes]]]:
    """What workers call to get texts -> ids; the tokenizer file travels to them once."""
    with open(tokenizer, encoding="utf-8") as f:
        shared = spark.sparkContext.broadcast(f.read())

    def make() -> Callable[[list[bytes]], list[bytes]]:
        ids = text_ids(shared.value)

        def coded(texts: list[bytes]) -> list[bytes]:
            if sum(map(len, texts)) > GROUP:
                return [b"".join(ids([block])[0] for block in text_blocks(t, GROUP)) for t in texts]
            return ids(texts)

        return coded

    return make


def _grouped(rows: Iterator[tuple[int | None, bytes]], size: int) -> Iterator[list[tuple[int | None, bytes]]]:
    """Documents in groups of about ``size`` bytes, a longer one alone."""
    held, weight = [], 0
    for row in rows:
        if held and weight + len(row[1]) > size:
            yield held
            held, weight = [], 0
        held.append(row)
        weight += len(row[1])
    if held:
        yield held


def _place(make, capacity: int, open_bins: int, end_id: int, with_ids: bool):
    names = [f.split()[0] for f in _PIECES.split(", ")] + ["ids"] * with_ids
    kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 6, pa.bool_()] + [pa.binary()] * with_ids
    schema = pa.schema(list(zip(names, kinds, strict=True)))

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True) if rows else [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], schema=schema)

    def closed(first: int, done, is_open: bool) -> Iterator[tuple]:
        number, fill, items = done
        for offset, piece in items:
            yield (*piece[:5], first + number, offset, fill, is_open, *piece[5:])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, bins = make(), Bins(capacity, open_bins)
        first = TaskContext.get().partitionId() << 33
        end, width = np.array([end_id], dtype="<u4").tobytes(), 4 * capacity
        out: list[tuple] = []
        for b in batches:
            for group in _grouped(zip(b.column("doc_id").to_pylist(), texts(b), strict=True), GROUP):
                for (doc, _), coded in zip(group, ids([t for _, t in group]), strict=True):
                    coded += end
                    for k, at in enumerate(range(0, len(coded), width)):
                        part = coded[at : at + width]
                        piece = (doc, k, at // 4, len(part) // 4, zlib.crc32(part), *[part] * with_ids)
                        for done in bins.give(len(part) // 4, piece):
                            out.extend(closed(first, done, False))
                if len(out) >= 10_000:
                    yield batch(out)
                    out = []
        for done in bins.rest():
            out.extend(closed(first, done, True))
        yield batch(out)

    return place


def _place_again(schema: pa.Schema, capacity: int, open_bins: int):
    """Pieces in new bins, numbered apart from those of the first round."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, first = Bins(capacity, open_bins), (1 << 62) + (TaskContext.get().partitionId() << 33)

        def batch(closed: list) -> pa.RecordBatch:
            rows = [{**piece, "bin": first + number, "offset": offset} for number, _, items in closed for offset, piece in items]
            return pa.RecordBatch.from_pylist(rows, schema)

        closed: list = []
        for b in batches:
            for piece in b.to_pylist():
                closed.extend(bins.give(piece["length"], piece))
            yield batch(closed)
            closed = []
        yield batch([*bins.rest()])

    return place


def pack(
    documents: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    open_bins: int = OPEN_BINS,
    end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset, and with ``with_ids`` the
    piece's ids as binary.

    Only documents longer than ``capacity`` are cut. A null or empty text is the end id alone. Null and repeated
    doc_ids are packed as any other row: each row is a document. Other columns are ignored. No documents give no rows.
    """
    spark = documents.sparkSession
    place = _place(token_ids(spark, tokenizer), capacity, open_bins, end_id, with_ids)
    schema = _PIECES + ", ids binary" * with_ids
    pieces = stored(doc_columns(documents, "doc_id", "text").mapInArrow(place, schema), "pieces")
    shown = ["doc_id", "piece", "start", "length", "ids_crc32", "bin", "offset", *["ids"] * with_ids]
    left = pieces.filter("open").select(shown)
    tasks = 1 + left.count() // SECOND_ROUND
    dealt = left.repartition(tasks, F.xxhash64("doc_id", "piece", "ids_crc32"))
    again = dealt.sortWithinPartitions(F.desc("length"), "doc_id", "piece", "ids_crc32")
    again = again.mapInArrow(_place_again(to_arrow_schema(left.schema), capacity, SECOND_ROUND), left.schema)
    out = pieces.filter("NOT open").select(shown).union(again)
    return out.withColumnRenamed("bin", "sequence_id")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"), default_tokenizer())

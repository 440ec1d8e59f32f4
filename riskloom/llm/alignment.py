"""Cross-tokenizer alignment through inverted pair bitmaps.

A byte-level BPE (A) and a piece BPE with byte fallback (B) encode the same
bytes. Offsets where tokens of both end cut them into groups; tokens whose byte
ranges overlap are linked.

The links of the whole corpus are kept inverted: for each id pair the set of
documents that hold it. Documents are numbered within blocks, so a pair's set is a
container per block, an array of 16-bit places or a bitmap, whichever is smaller,
and further containers hold the bits of the multiplicity less one (its planes).
Containers of different blocks are disjoint: their union is a pair's bitmap and
their popcounts add up to its document count, its planes to its link count. The
postings then carry the counts back: a block reads its containers with each pair's
count and adds them up at the places they hold, so a document's scores need no
list of its links.

A text is cut where neither tokenizer merges across: before a single space between
two other characters. A worker keeps the alignment of the stretches it has met.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import doc_columns, read, small, stored, worker_memory

BYTE_BPE, PIECE_BPE = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: A worker forgets its stretches beyond so many bytes of them and their alignments; longer stretches are never kept.
MEMORY, LONGEST = 96 << 20, 256
#: Stretches encoded in one line; texts aligned together, in characters; a block's postings and documents, whose places take 16 bits.
LINE, TOGETHER, BLOCK_ENTRIES, BLOCK_DOCS = 2_000, 1 << 20, 2_000_000, 1 << 16
_CUT = re.compile(r"(?<=\S) (?=\S)")
_MARK = "▁"
_B_WRITTEN = 1 << 18  # place of B's ids in the list of written ids


def default_files() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path(BYTE_BPE), public_tokenizers.path(PIECE_BPE)


def _byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write bytes with: printable Latin-1 as itself, the rest from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


@dataclass(frozen=True)
class Aligned:
    """Pieces of text one after the other: where the tokens, groups and links of each end."""

    a_ends: np.ndarray
    b_ends: np.ndarray
    group_ends: np.ndarray
    link_ends: np.ndarray
    links: np.ndarray  # a·2^32 + b
    written: np.ndarray  # places in the list of Aligner.written, tokens in the order of the groups' text


def align(a: np.ndarray, b: np.ndarray, a_bytes: np.ndarray, b_bytes: np.ndarray, a_ends: np.ndarray, b_ends: np.ndarray) -> Aligned:
    """Groups and links of pieces' tokens, given the bytes of each. Pieces end where tokens of both end; no token is
    empty."""
    a_end, b_end = np.cumsum(a_bytes), np.cumsum(b_bytes)
    last = np.searchsorted(b_end, a_end)  # the B token that holds the last byte of each A token
    closes = b_end[last] == a_end
    first = np.concatenate([[0], last[:-1] + closes[:-1]])
    number = last - first + 1
    link_ends = np.cumsum(number)
    b_of = np.arange(link_ends[-1]) + np.repeat(first - link_ends + number, number)
    links = (np.repeat(a, number) << 32) + b[b_of]
    # A group's A tokens stand before its B tokens.
    b_closes = np.zeros(len(b), bool)
    b_closes[last[closes]] = True
    a_last, b_last = np.flatnonzero(closes) + 1, np.flatnonzero(b_closes) + 1
    a_group, b_group = np.cumsum(closes) - closes, np.cumsum(b_closes) - b_closes
    written = np.empty(len(a) + len(b), np.int64)
    written[np.arange(len(a)) + np.concatenate([[0], b_last])[a_group]] = 2 * a + closes
    written[np.arange(len(b)) + a_last[b_group]] = 2 * b + b_closes + _B_WRITTEN
    groups = np.concatenate([[0], np.cumsum(closes)])
    return Aligned(a_ends, b_ends, groups[a_ends], np.concatenate([[0], link_ends])[a_ends], links, written)


class Aligner:
    """Both tokenizers of a worker, and the stretches it knows."""

    def __init__(self, files: tuple[str, str]):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(files[0])
        self.a.encode_special_tokens = True  # their strings inside texts are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_file=files[1])
        letters = _byte_letters()
        self.a_bytes = {i: bytes(letters[c] for c in piece) for piece, i in self.a.get_vocab(with_added_tokens=False).items()}
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(_MARK, " ").encode() for i, p in enumerate(pieces)
        ]
        ids = range(max(self.a_bytes) + 1)
        self.a_sizes = np.array([len(self.a_bytes.get(i, b"")) for i in ids])
        self.b_sizes = np.array([len(x) for x in self.b_bytes])
        # Ids as the groups' text writes them, inside a group and at the end of its A and B part.
        self.written = [b"%d%s" % (i, end) for i in ids for end in (b",", b"|")]
        self.written += [b""] * (_B_WRITTEN - len(self.written))
        self.written += [b"%d%s" % (i, end) for i in range(len(pieces)) for end in (b",", b";")]
        # A space can be cut at only if no piece goes on across one.
        self.cuts = not any(re.search(f"[^{_MARK}]{_MARK}", p) for p in pieces)
        self.a_known: dict[str, bytes] = {}
        self.b_known: dict[str, bytes] = {}
        self.wrong: set[str] = set()
        self.passing: list[str] = []
        self.held = 0

    def stretches(self, text: str) -> list[str]:
        """A text in stretches; each stands after a space that is not in it."""
        return _CUT.split(text) if self.cuts else [text]

    def _right(self, a: list[int], b: list[int], want: bytes) -> bool:
        """Whether both give the bytes back."""
        try:
            return b"".join(map(self.a_bytes.__getitem__, a)) == want == b"".join(map(self.b_bytes.__getitem__, b))
        except KeyError:
            return False

    def _line(self, words: list[str]) -> bool:
        """Learn stretches from one line of them, told apart again by their bytes; False if that cannot be done."""
        line = " ".join(words)
        want = b" " + line.encode()
        a, b = self.a.encode_batch_fast([" " + line], add_special_tokens=False)[0].ids, self.b.encode(line)
        if not self._right(a, b, want):
            return False
        ends = np.cumsum([len(w.encode()) + 1 for w in words])
        cut = []
        for ids, sizes in ((a, self.a_sizes), (b, self.b_sizes)):
            ids = np.array(ids, "<u4")
            at = np.cumsum(sizes[ids])
            last = np.searchsorted(at, ends)
            if not np.array_equal(at[last], ends):
                return False
            raw, to = ids.tobytes(), (4 * (last + 1)).tolist()
            cut.append([raw[x:y] for x, y in zip([0, *to], to, strict=False)])
        for known, parts in zip((self.a_known, self.b_known), cut, strict=True):
            known.update(zip(words, parts, strict=True))
        self.held += 300 * len(words) + 4 * (len(a) + len(b)) + 2 * len(line)
        return True

    def _learn(self, new: list[str]) -> None:
        plain = [w for w in new if self.cuts and len(w) <= LONGEST and w and w.strip() == w]
        other = [w for w in new if not (self.cuts and len(w) <= LONGEST and w and w.strip() == w)]
        for at in range(0, len(plain), LINE):
            if not self._line(plain[at : at + LINE]):
                other += plain[at : at + LINE]
        if not other:
            return
        coded = self.a.encode_batch_fast([" " + w for w in other], add_special_tokens=False)
        for word, found, b in zip(other, coded, self.b.encode(other, num_threads=1), strict=True):
            a = found.ids
            if self._right(a, b, b" " + word.encode()):
                self.a_known[word], self.b_known[word] = np.array(a, "<u4").tobytes(), np.array(b, "<u4").tobytes()
            else:
                self.wrong.add(word)
            if len(word) > LONGEST:
                self.passing.append(word)
            self.held += 300 + 2 * len(word) + 4 * (len(a) + len(b))

    def ids(self, pieces: list[list[str]]) -> list[tuple[bytes, bytes] | None]:
        """Little-endian 32-bit ids of whole pieces, given by their stretches; None for a piece without tokens, that is
        if a tokenizer does not give its bytes back."""
        if self.held > MEMORY:
            for known in (self.a_known, self.b_known, self.wrong):
                known.clear()
            self.held = 0
        words = set().union(*pieces)
        words.difference_update(self.a_known)
        self._learn(list(words.difference(self.wrong)))
        a, b, wrong = self.a_known.__getitem__, self.b_known.__getitem__, self.wrong
        out = [None if wrong and not wrong.isdisjoint(p) else (b"".join(map(a, p)), b"".join(map(b, p))) for p in pieces]
        for word in self.passing:
            for known in (self.a_known, self.b_known):
                known.pop(word, None)
            wrong.discard(word)
        self.passing.clear()
        return out

    def aligned(self, pieces: list[tuple[bytes, bytes]]) -> Aligned:
        a, b = (np.frombuffer(b"".join(x), "<u4").astype(np.int64) for x in zip(*pieces, strict=True))
        ends = [np.cumsum([len(x) // 4 for x in side]) for side in zip(*pieces, strict=True)]
        return align(a, b, self.a_sizes[a], self.b_sizes[b], *ends)


def _aligner(files: tuple[str, str]) -> Aligner:
    memory = worker_memory("alignment")
    if files not in memory:
        memory.clear()
        memory[files] = Aligner(files)
    return memory[files]


_FOUND = pa.schema(
    [
        ("block", pa.int64()), ("place", pa.int32()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()),
        ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("pair", pa.int64()),
        ("plane", pa.int8()), ("dense", pa.bool_()), ("bits", pa.binary()), ("found", pa.string()),
    ]
)
_FOUND_DDL = (
    "block long, place int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pair long, "
    "plane byte, dense boolean, bits binary, found string"
)


def _some(rows: int, **columns) -> pa.RecordBatch:
    """A batch of the named columns, null in the others."""
    made = [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(rows, f.type) for f in _FOUND]
    return pa.RecordBatch.from_arrays(made, schema=_FOUND)


def containers(pair: np.ndarray, place: np.ndarray, block_docs: int) -> Iterator[tuple[bool, np.ndarray, pa.Array]]:
    """(dense, pairs, bits): a container per distinct pair; ``pair`` is sorted, places rise within one."""
    starts = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]])) if len(pair) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(starts, len(pair)))
    dense = sizes * 16 > block_docs
    sparse = np.repeat(~dense, sizes)
    if sparse.any():
        offsets = np.concatenate([[0], np.cumsum(2 * sizes[~dense])]).astype(np.int32)
        data = place[sparse].astype("<u2").tobytes()
        bits = pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data)])
        yield False, pair[starts[~dense]], bits
    if dense.any():
        made = []
        for s, n in zip(starts[dense], sizes[dense], strict=True):
            flags = np.zeros(block_docs, np.uint8)
            flags[place[s : s + n]] = 1
            made.append(np.packbits(flags, bitorder="little").tobytes())
        yield True, pair[starts[dense]], pa.array(made, pa.binary())


def places(bits: pa.Array, dense: bool) -> tuple[np.ndarray, np.ndarray]:
    """(container, place): all members of an array of containers of one kind."""
    if dense:
        found = [np.flatnonzero(np.unpackbits(np.frombuffer(b.as_buffer(), np.uint8), bitorder="little")) for b in bits]
        sizes = [len(f) for f in found]
        return np.repeat(np.arange(len(found)), sizes), np.concatenate(found) if found else np.zeros(0, np.int64)
    offsets = np.frombuffer(bits.buffers()[1], np.int32)[bits.offset : bits.offset + len(bits) + 1]
    data = np.frombuffer(bits.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]].view("<u2") if len(bits) else np.zeros(0, "<u2")
    return np.repeat(np.arange(len(bits)), np.diff(offsets) // 2), data.astype(np.int64)


class _Block:
    """Postings of one block of documents."""

    def __init__(self, number: int):
        self.number, self.docs, self.entries = number, 0, 0
        self.pairs: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.places: list[np.ndarray] = []

    def add(self, links: np.ndarray) -> int:
        place = self.docs
        pairs, counts = np.unique(links, return_counts=True)
        self.pairs.append(pairs)
        self.counts.append(counts.astype(np.int32))
        self.places.append(np.full(len(pairs), place, np.uint16))
        self.docs, self.entries = place + 1, self.entries + len(pairs)
        return place

    def full(self) -> bool:
        return self.entries >= BLOCK_ENTRIES or self.docs == BLOCK_DOCS

    def postings(self) -> Iterator[pa.RecordBatch]:
        """Plane 0 is the bitmap of the documents, plane k + 1 that of bit k of the multiplicity less one."""
        pair, more, place = (np.concatenate(x) for x in (self.pairs, self.counts, self.places))
        order = np.argsort(pair, kind="stable")
        pair, more, place = pair[order], more[order] - 1, place[order]
        plane = 0
        while len(pair):
            keep = slice(None) if plane == 0 else (more >> (plane - 1)) & 1 == 1
            for dense, pairs, bits in containers(pair[keep], place[keep], self.docs):
                for at in range(0, len(pairs), 50_000):
                    part = slice(at, at + 50_000)
                    n = len(pairs[part])
                    yield _some(
                        n, block=np.full(n, self.number), pair=pairs[part], plane=np.full(n, plane, np.int8),
                        dense=np.full(n, dense), bits=bits[part],
                    )
            some = more >> plane > 0
            pair, more, place = pair[some], more[some], place[some]
            plane += 1


class _Text:
    """A document while its pieces are aligned."""

    def __init__(self, doc_id: int | None, text: str | None, aligner: Aligner):
        self.doc_id, self.n_a, self.n_b, self.n_groups = doc_id, 0, 0, 0
        self.links: list[np.ndarray] = []
        self.digest, self.right = hashlib.sha256(), bool(text)
        words, self.pieces = aligner.stretches(text) if text else [], []
        if text and len(text) <= TOGETHER:
            self.pieces.append(words)
            return
        size = low = 0
        for k, word in enumerate(words):
            size += len(word) + 1
            if size >= TOGETHER or k + 1 == len(words):
                self.pieces.append(words[low : k + 1])
                size, low = 0, k + 1

    def add(self, n_a: int, n_b: int, n_groups: int, links: np.ndarray, written: bytes) -> None:
        self.digest.update(b";" + written[:-1] if self.n_a else written[:-1])
        self.n_a, self.n_b, self.n_groups = self.n_a + n_a, self.n_b + n_b, self.n_groups + n_groups
        self.links.append(links)

    def row(self, block: _Block) -> tuple:
        if not self.right:
            return None, None, self.doc_id, 0, 0, 0, 0, ""
        links = np.concatenate(self.links)
        place = block.add(links)
        return block.number, place, self.doc_id, self.n_a, self.n_b, self.n_groups, len(links), self.digest.hexdigest()


def _align_texts(aligner: Aligner, texts: list[_Text]) -> None:
    """All pieces of the texts, about ``TOGETHER`` characters of them at once."""
    some, size = [], 0
    work = [(t, piece) for t in texts for piece in t.pieces]
    for k, (text, piece) in enumerate(work):
        some.append((text, piece))
        size += sum(map(len, piece)) + len(piece)
        if size < TOGETHER and k + 1 < len(work):
            continue
        ids = aligner.ids([p for _, p in some])
        for (t, _), found in zip(some, ids, strict=True):
            t.right &= found is not None
        whole = [(t, found) for (t, _), found in zip(some, ids, strict=True) if found is not None]
        some, size = [], 0
        if not whole:
            continue
        made = aligner.aligned([found for _, found in whole])
        a0 = b0 = g0 = l0 = 0
        for (t, _), a1, b1, g1, l1 in zip(whole, *(x.tolist() for x in (made.a_ends, made.b_ends, made.group_ends, made.link_ends)), strict=True):
            written = b"".join(map(aligner.written.__getitem__, made.written[a0 + b0 : a1 + b1].tolist()))
            t.add(a1 - a0, b1 - b0, g1 - g0, made.links[l0:l1], written)
            a0, b0, g0, l0 = a1, b1, g1, l1


def _found(files: tuple[str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(files)
        number = TaskContext.get().partitionId() << 32
        block = _Block(number)
        for b in batches:
            ids, texts = b.column("doc_id").to_pylist(), b.column("text")
            for low, high in _together(texts):
                held = [_Text(i, t, aligner) for i, t in zip(ids[low:high], texts[low:high].to_pylist(), strict=True)]
                _align_texts(aligner, held)
                out = []
                for text in held:
                    out.append(text.row(block))
                    if block.full():
                        yield from block.postings()
                        number += 1
                        block = _Block(number)
                names = _FOUND.names[:8]
                yield _some(len(out), **dict(zip(names, zip(*out, strict=True), strict=True)), found=["d"] * len(out))
        if block.docs:
            yield from block.postings()

    return run


def _together(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``TOGETHER`` bytes."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    low = total = 0
    for k, size in enumerate(sizes.tolist()):
        total += size
        if total >= TOGETHER:
            yield low, k + 1
            low, total = k + 1, 0
    if low < len(sizes):
        yield low, len(sizes)


_SCORES = pa.schema([("block", pa.int64()), ("place", pa.int32()), ("n_best", pa.int64()), ("count_sum", pa.int64())])


def _scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds each pair's count up at the places of its containers; rows of a block follow each other."""
    at, sums = None, np.zeros((2, BLOCK_DOCS), np.int64)

    def send() -> pa.RecordBatch:
        held = np.flatnonzero(sums[1]).astype(np.int32)  # a count is at least 1
        made = [np.full(len(held), at, np.int64), held, sums[0, held], sums[1, held]]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(made, _SCORES, strict=True)], schema=_SCORES)

    for b in batches:
        block = b.column("block").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(block)]
        for low, high in zip(cuts, cuts[1:], strict=False):
            if low == high:
                continue
            if block[low] != at:
                if at is not None:
                    yield send()
                    sums[:] = 0
                at = int(block[low])
            part = b.slice(low, high - low)
            dense = part.column("dense").to_numpy(zero_copy_only=False).astype(bool)
            for kind in (False, True):
                rows = part.filter(pa.array(dense == kind))
                if not rows.num_rows:
                    continue
                plane = rows.column("plane").to_numpy().astype(np.int64)
                weight = np.where(plane == 0, 1, 1 << np.maximum(plane - 1, 0))
                docs = rows.column("docs").to_numpy() * weight
                best = rows.column("best").to_numpy(zero_copy_only=False).astype(np.int64) * weight
                of, place = places(rows.column("bits"), kind)
                np.add.at(sums[0], place, best[of])
                np.add.at(sums[1], place, docs[of])
    if at is not None:
        yield send()


def pair_counts(postings: DataFrame) -> DataFrame:
    """(pair, docs, links, best): in how many documents a pair is linked, how often, and whether its A id is linked in
    no more documents with any other B id. Popcounts of containers, added up."""
    size = F.when(F.col("dense"), F.bitmap_count("bits")).otherwise(F.octet_length("bits") / 2).cast("long")
    weight = F.when(F.col("plane") == 0, F.lit(1)).otherwise(F.expr("shiftleft(1L, plane - 1)"))
    counts = postings.withColumn("_n", size).groupBy("pair").agg(
        F.sum(F.when(F.col("plane") == 0, F.col("_n"))).alias("docs"), F.sum(F.col("_n") * weight).alias("links")
    )
    counts = stored(counts.withColumn("_a", F.shiftright("pair", 32)), "pair-counts")
    most = counts.groupBy("_a").agg(F.max("docs").alias("_most"))
    return stored(counts.join(most, "_a").select("pair", "docs", "links", (F.col("docs") == F.col("_most")).alias("best")), "pairs")


def alignments(documents: DataFrame, files: tuple[str, str]) -> tuple[DataFrame, DataFrame]:
    """(documents, pairs): per document (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), and the
    corpus-wide pairs of :func:`pair_counts`.

    Null and empty texts, and texts that either tokenizer does not give back byte by byte (as one with U+2581 in it),
    have no tokens: zeros and ''. Null ids stay null, repeated rows count each."""
    whole = doc_columns(documents, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = stored(whole.mapInArrow(_found(files), _FOUND_DDL), "alignment")
    postings = found.filter(F.col("found").isNull()).select("block", "pair", "plane", "dense", "bits")
    pairs = pair_counts(postings)
    scored = postings.join(small(pairs.select("pair", "docs", "best")), "pair").drop("pair")
    scores = scored.repartition("block").sortWithinPartitions("block").mapInArrow(
        _scores, "block long, place int, n_best long, count_sum long"
    )
    docs = found.filter("found = 'd'").select("block", "place", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    each = docs.join(scores, ["block", "place"], "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0)).alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).alias("count_sum"), "groups_sha256",
    )
    return each, pairs


def op12_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens, groups and links of every document under both tokenizers, see :func:`alignments` for empty texts, ties
    (every best pair of an A id counts) and repeated rows."""
    return alignments(read(spark, sf_dir, "documents"), default_files())[0]

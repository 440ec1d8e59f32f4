"""Token counts of a unigram tokenizer without its tokens.

An Aho-Corasick automaton over the vocabulary names, at each character, all
pieces that end there, longest first. Dynamic programming keeps the best score
of the text so far and the number of pieces on that path, nothing else: no
lattice and no way back. Rules where scores tie or nothing matches are those of
the ``tokenizers`` library's unigram model: of equal scores the earlier start
wins, a character without a piece of its own may be unknown at ten below the
lowest score, and unknown characters become their bytes' pieces or, without
those, one unknown piece per run.

White space ends a word, every word is encoded behind the vocabulary's space
mark, so a worker counts each distinct word once.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from riskloom.llm.common import doc_columns, read, text_blocks, texts, worker_memory

MARK = "▁"
VOCABULARY = "piece_bpe_32k.model"
#: How far an unknown character scores below the lowest piece; fixed by the tokenizer.
UNKNOWN_PENALTY = 10.0
#: Words a worker remembers, and the bytes of the longest: together a bound of its memory. Others are counted each time.
MAX_WORDS, LONGEST_KEPT = 600_000, 256
_STEP = 1 << 16  # characters between two cuts of the path's state


def vocabulary(path: str) -> list[tuple[str, float]]:
    """(piece, score) by id, from a SentencePiece model or a tokenizers file with a unigram model."""
    if path.endswith(".json"):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        if model["type"] != "Unigram":
            raise ValueError(f"{path} has no unigram vocabulary")
        return [(p, float(s)) for p, s in model["vocab"]]
    import sentencepiece

    held = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(held.id_to_piece(i), held.get_score(i)) for i in range(held.get_piece_size())]


def counter(pieces: list[tuple[str, float]], mark: str = MARK) -> Callable[[str], tuple[int, float]]:
    """word -> (pieces, score) of its best path."""
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for piece, value in reversed(pieces):  # of equal pieces the first id stands
        if piece:
            automaton.add_word(piece, (len(piece), value))
    automaton.make_automaton()
    alone = frozenset(p for p, _ in pieces if len(p) == 1)
    known = {p for p, _ in pieces}
    by_bytes = all(f"<0x{b:02X}>" in known for b in range(256))
    unknown = min(v for _, v in pieces) - UNKNOWN_PENALTY
    longest = max(len(p) for p in known)

    def long(text: str) -> tuple[int, float]:
        """As ``count``, with the state of the last ``longest`` places only, however long the text is."""
        best, pieces_upto, open_run, base = [0.0], [0], False, 0  # of the places from ``base`` on
        matches = automaton.iter(text)
        end, (size, value) = next(matches, (-1, (0, 0.0)))
        for at, char in enumerate(text):
            if len(best) > longest + _STEP:
                base += len(best) - longest
                del best[:-longest], pieces_upto[:-longest]
            top, number, run = None, 0, False
            while end == at:
                start = at + 1 - size - base
                score = best[start] + value
                if top is None or score > top:
                    top, number = score, pieces_upto[start] + 1
                end, (size, value) = next(matches, (-1, (0, 0.0)))
            if char not in alone:
                score = best[at - base] + unknown
                if top is None or score > top:
                    more = len(char.encode("utf-8", "replace")) if by_bytes else int(not open_run)
                    top, number, run = score, pieces_upto[at - base] + more, True
            best.append(top)
            pieces_upto.append(number)
            open_run = run
        return pieces_upto[-1], best[-1]

    def count(word: str) -> tuple[int, float]:
        text = mark + word
        n = len(text)
        if n > _STEP:
            return long(text)
        best, pieces_upto, open_run = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        matches = automaton.iter(text)
        end, (size, value) = next(matches, (n, (0, 0.0)))
        for at, char in enumerate(text):
            top, number, run = None, 0, False
            while end == at:
                start = at + 1 - size
                score = best[start] + value
                if top is None or score > top:
                    top, number, run = score, pieces_upto[start] + 1, False
                end, (size, value) = next(matches, (n, (0, 0.0)))
            if char not in alone:
                score = best[at] + unknown
                if top is None or score > top:
                    more = len(char.encode("utf-8", "replace")) if by_bytes else int(not open_run[at])
                    top, number, run = score, pieces_upto[at] + more, True
            best[at + 1], pieces_upto[at + 1], open_run[at + 1] = top, number, run
        return pieces_upto[n], best[n]

    return count


_COUNTS = "doc_id long, n_words long, n_tokens long, score double"


def token_counts(documents: DataFrame, path: str, mark: str = MARK) -> DataFrame:
    """One row per document: doc_id, n_words, n_tokens, score (of the best paths). A null or empty text has 0 of each;
    null and repeated doc_ids are documents of their own. The vocabulary travels to the workers once."""
    shared = documents.sparkSession.sparkContext.broadcast(vocabulary(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = shared.value
        memory = worker_memory(f"unigram-{mark}-{zlib.crc32(repr(pieces).encode())}")
        if not memory:
            memory.update(count=counter(pieces, mark), words={})
        count, words = memory["count"], memory["words"]

        def learn(found: list[bytes]) -> dict[bytes, tuple[int, float]]:
            """Counts of words that are not remembered; short ones are from now on."""
            if len(words) > MAX_WORDS:
                words.clear()
            new = {w: count(w.decode("utf-8")) for w in set(found).difference(words)}
            words.update((w, c) for w, c in new.items() if len(w) <= LONGEST_KEPT)
            return new

        for b in batches:
            rows = []
            for text in texts(b):
                n = tokens = 0
                score = 0.0
                for block in text_blocks(text):
                    found = block.split()
                    try:
                        counted = [words[w] for w in found]
                    except KeyError:
                        new = learn(found)
                        counted = [words.get(w) or new[w] for w in found]
                    n += len(found)
                    tokens += sum(c for c, _ in counted)
                    score += sum(s for _, s in counted)
                rows.append((n, tokens, score))
            columns = zip(*rows, strict=True) if rows else [[]] * 3
            made = [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64()), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *made], names=[f.split()[0] for f in _COUNTS.split(", ")])

    return doc_columns(documents, "doc_id", "text").mapInArrow(run, _COUNTS)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The provided piece vocabulary, its pieces and scores read as a unigram model: no unigram file is provided, and
    tokenizers are not trained here."""
    return token_counts(read(spark, sf_dir, "documents"), default_vocabulary())

"""Token counts without tokens: Viterbi over unigram vocabulary matches.

Texts are cut like a metaspace pre-tokenizer does: blanks (U+0020) become U+2581, one is put in
front unless the text starts with one, and a segment starts at each of them. In a segment an
Aho-Corasick automaton lists all vocabulary pieces by their ends; for each end the best sum of
scores and the number of pieces on that path are carried on. Ties keep the piece that starts
first, as a tokenizer does that goes through the starts in order and replaces a path only by a
better one. A character that is no piece by itself costs the least score minus 10 and counts one
for each of its UTF-8 bytes (byte fallback), or one for each run of such characters.

Null and empty texts have 0 tokens. Equal rows get equal counts. An empty table gives an empty
one. Whole texts are counted; only the memory of counted segments is bounded.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
KEPT_SEGMENTS = 300_000
LONGEST_KEPT = 64


def read_pieces(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a vocabulary file, read on the driver."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


class SegmentCounts(dict):
    """Tokens of a segment, worked out on first use and kept while there is room."""

    def __init__(self, pieces: list[tuple[str, float]], byte_fallback: bool = True):
        import ahocorasick

        super().__init__()
        self.matches = ahocorasick.Automaton()
        for piece, score in pieces:
            if piece:
                self.matches.add_word(piece, (len(piece), score))
        self.empty = not len(self.matches)
        if not self.empty:
            self.matches.make_automaton()
        self.unknown = min((score for _, score in pieces), default=0.0) - UNKNOWN_PENALTY
        self.byte_fallback = byte_fallback

    def __missing__(self, segment: str) -> int:
        n = self.count(segment)
        if len(segment) <= LONGEST_KEPT:
            if len(self) >= KEPT_SEGMENTS:
                self.clear()
            self[segment] = n
        return n

    def count(self, segment: str) -> int:
        size = len(segment)
        score, pieces, unknown_end = [0.0] * (size + 1), [0] * (size + 1), [False] * (size + 1)
        found = [] if self.empty else self.matches.iter(segment)
        at, single, length_here = 0, False, 0

        def close(end: int) -> None:
            # The character before `end` as an unknown one, where it is no piece.
            if single:
                return
            other = score[end - 1] + self.unknown
            if not length_here or other > score[end]:
                if self.byte_fallback:
                    more = len(segment[end - 1].encode("utf-8", "surrogatepass"))
                else:
                    more = 0 if unknown_end[end - 1] else 1
                score[end], pieces[end], unknown_end[end] = other, pieces[end - 1] + more, True

        for last, (length, worth) in found:
            end = last + 1
            if end != at:
                for passed in range(max(at, 1), end):
                    close(passed)
                    single, length_here = False, 0
                at = end
            path = score[end - length] + worth
            if not length_here or path > score[end] or (path == score[end] and length > length_here):
                score[end], pieces[end], length_here = path, pieces[end - length] + 1, length
            single = single or length == 1
        for passed in range(max(at, 1), size + 1):
            close(passed)
            single, length_here = False, 0
        return pieces[size]


def count_text(text: str | None, counts: SegmentCounts) -> int:
    if not text:
        return 0
    marked = text.replace(" ", SPACE)
    rest = marked[1:] if marked[0] == SPACE else marked
    return sum([counts[SPACE + segment] for segment in rest.split(SPACE)])


def count_tokens(
    documents: DataFrame, pieces: list[tuple[str, float]], byte_fallback: bool = True
) -> DataFrame:
    """doc_id and n_tokens of every whole text. The vocabulary is broadcast; a file bounds it."""
    shared = documents.sparkSession.sparkContext.broadcast(pieces)

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = SegmentCounts(shared.value, byte_fallback)
        for batch in batches:
            totals = [count_text(text.as_py(), counts) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(totals, pa.int64())], ["doc_id", "n_tokens"]
            )

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(tally, f"doc_id {kind}, n_tokens long")

"""Token counts by byte-pair merging over a heap and a linked list."""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Words a task remembers with their counts; the memory is emptied when full, which changes no result.
MEMORY_WORDS = 200_000
SPACE = "▁"


class PieceCounter:
    """Counts the pieces of a byte-fallback BPE model without naming them.

    ``ranks`` maps a piece to its merge order (lower merges first).  No piece has a space mark after another character, so no
    merge crosses from a letter to a following mark: a text falls apart into runs of marks with the word after them, and each
    distinct run is merged once.
    """

    def __init__(self, model_path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        ids = [i for i in range(model.get_piece_size())
               if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        scores = sorted({model.get_score(i) for i in ids}, reverse=True)
        rank = {score: n for n, score in enumerate(scores)}
        self.ranks = {model.id_to_piece(i): rank[model.get_score(i)] for i in ids}
        if any(SPACE in piece.lstrip(SPACE) for piece in self.ranks):
            raise ValueError("pieces of this model cross words")
        self.runs = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        self.known: dict[str, int] = {}

    def merged(self, symbols: str) -> int:
        """Initial symbols minus merges, where a symbol outside the vocabulary counts its bytes."""
        ranks, n = self.ranks, len(symbols)
        count = sum(1 if c in ranks else len(c.encode("utf-8", "surrogatepass")) for c in symbols)
        if symbols in ranks and n == 1:
            return 1
        piece, left, right = list(symbols), list(range(-1, n - 1)), list(range(1, n + 1))
        heap = []
        for i in range(n - 1):
            if (r := ranks.get(symbols[i] + symbols[i + 1])) is not None:
                heap.append((r, i, 2))
        heapq.heapify(heap)
        while heap:
            _, i, size = heapq.heappop(heap)
            j = right[i]
            # An entry is stale once either side was merged away or grew: the lengths no longer add up.
            if not piece[i] or j >= n or len(piece[i]) + len(piece[j]) != size:
                continue
            piece[i] += piece[j]
            piece[j] = ""
            right[i] = right[j]
            if right[j] < n:
                left[right[j]] = i
            count -= 1
            if left[i] >= 0:
                k = left[i]
                if (r := ranks.get(piece[k] + piece[i])) is not None:
                    heapq.heappush(heap, (r, k, len(piece[k]) + len(piece[i])))
            if right[i] < n:
                if (r := ranks.get(piece[i] + piece[right[i]])) is not None:
                    heapq.heappush(heap, (r, i, len(piece[i]) + len(piece[right[i]])))
        return count

    def count(self, text: str) -> int:
        if not text:
            return 0
        known, total = self.known, 0
        for run in self.runs.findall(SPACE + text.replace(" ", SPACE)):
            n = known.get(run)
            if n is None:
                n = self.merged(run)
                if len(run) <= 64:
                    if len(known) >= MEMORY_WORDS:
                        known.clear()
                    known[run] = n
            total += n
        return total


def count_tokens(docs: DataFrame, model_path: str, limit: int = 4096) -> DataFrame:
    """Per document: doc_id, n_bytes, n_tokens, over_limit (more tokens than ``limit``).

    Counts what the model gives for the whole text, without begin, end or added special tokens.  Rows stay where they are read:
    one narrow pass without a shuffle.  Null and empty texts have no bytes and no tokens; repeated rows repeat.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PieceCounter(model_path)
        for batch in batches:
            counts = [counter.count(text) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), pa.array(counts, pa.int64())],
                                             names=["doc_id", "n_bytes", "n_tokens"])

    text = F.coalesce("text", F.lit(""))
    counted = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
               .mapInArrow(count, "doc_id long, n_bytes long, n_tokens long"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)

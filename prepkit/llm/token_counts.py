"""Token counts by byte-pair merging over a heap and a linked list, without emitting ids.

The vocabulary is read from a sentencepiece BPE model file. A text is cut where no piece can span: before
each run of word marks. Each part starts as a linked list of its symbols; the adjacent pair whose joined
piece ranks best (ties: leftmost) is popped from a heap and merged until none is left. The count is the
initial symbols minus the merges, with a symbol outside the vocabulary counted by its UTF-8 bytes when the
model falls back to bytes. Counts of parts are remembered within a task, up to a fixed number of parts.

Defined cases: a null or empty text has no tokens; special strings in a text are ordinary text; texts are
never cut; each row is counted by itself, so repeated rows repeat. Models that map characters, strip
spaces or hold user-defined pieces are refused, since their counts need the library's normaliser.
"""

from __future__ import annotations

import heapq
import re
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
#: Parts remembered by a task, and their longest; beyond, remembering starts anew.
REMEMBERED, LONGEST = 400_000, 64


class MergeCounter:
    """Counts tokens of texts for one vocabulary."""

    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2

        spec = sentencepiece_model_pb2.ModelProto()
        spec.ParseFromString(model)
        normal = spec.normalizer_spec
        kinds = {p.type for p in spec.pieces}
        kind = sentencepiece_model_pb2.ModelProto.SentencePiece
        if spec.trainer_spec.model_type != sentencepiece_model_pb2.TrainerSpec.BPE:
            raise ValueError("not a byte-pair model")
        if normal.precompiled_charsmap or normal.remove_extra_whitespaces or kinds & {kind.USER_DEFINED, kind.UNUSED}:
            raise ValueError("the model maps, strips or defines text beyond merges")
        self.rank = {p.piece: -p.score for p in spec.pieces if p.type == kind.NORMAL}
        if any(MARK in p.lstrip(MARK) for p in self.rank):
            raise ValueError("pieces span words")
        self.prefix = MARK if normal.add_dummy_prefix else ""
        self.bytes = spec.trainer_spec.byte_fallback
        self.known: dict[str, int] = {}

    def part(self, text: str) -> int:
        """Tokens of one part, by merging."""
        rank = self.rank
        n = len(text)
        if n == 1 or text in rank and n == 2:
            return self._symbols([text])
        symbol: list[str | None] = list(text)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = []
        for i in range(n - 1):
            score = rank.get(text[i : i + 2])
            if score is not None:
                heap.append((score, i, i + 1, 2))
        heapq.heapify(heap)
        merges = 0
        while heap:
            _, left, right, size = heapq.heappop(heap)
            a, b = symbol[left], symbol[right]
            # A pair is stale once either side has been merged away or has grown.
            if a is None or b is None or after[left] != right or len(a) + len(b) != size:
                continue
            symbol[left], symbol[right] = a + b, None
            merges += 1
            after[left] = after[right]
            if after[right] >= 0:
                before[after[right]] = left
            for x, y in ((before[left], left), (left, after[left])):
                if x >= 0 and y >= 0:
                    joined = symbol[x] + symbol[y]
                    score = rank.get(joined)
                    if score is not None:
                        heapq.heappush(heap, (score, x, y, len(joined)))
        return n - merges + self._fallback(symbol)

    def _symbols(self, symbols: list[str]) -> int:
        return len(symbols) + self._fallback(symbols)

    def _fallback(self, symbols) -> int:
        """What unknown symbols add to the number of symbols."""
        if self.bytes:
            return sum(len(s.encode()) - 1 for s in symbols if s is not None and len(s) == 1 and s not in self.rank)
        extra, last = 0, False
        for s in symbols:
            if s is not None:
                unknown = s not in self.rank
                extra -= unknown and last
                last = unknown
        return extra

    def count(self, text: str) -> int:
        if not text:
            return 0
        known = self.known
        total = 0
        # One part is a run of marks with the other characters up to the next mark.
        for part in _PARTS.findall(self.prefix + text.replace(" ", MARK)):
            n = known.get(part)
            if n is None:
                n = self.part(part)
                if len(part) <= LONGEST:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[part] = n
            total += n
        return total


_PARTS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


def count_tokens(docs: DataFrame, model_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_bytes, n_tokens`` of every row. ``model_path`` is read by the driver; its size is checked."""
    model = Path(model_path).read_bytes()
    if len(model) > 64 << 20:
        raise ValueError("a vocabulary file of over 64 MB")

    def count(batches):
        counter = MergeCounter(model)
        for batch in batches:
            texts = batch.column(1)
            sizes = np.fromiter((counter.count(t.as_py() or "") for t in texts), np.int64, len(texts))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(sizes)], ["key", "n_bytes", "n_tokens"]
            )

    n_bytes = F.coalesce(F.octet_length(text), F.lit(0)).cast("long")
    cells = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), n_bytes.alias("n_bytes"))
    kind = cells.schema["key"].dataType.simpleString()
    return cells.mapInArrow(count, f"key {kind}, n_bytes long, n_tokens long").withColumnRenamed("key", key)

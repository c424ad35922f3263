"""Token counts of byte-level byte-pair encoders by merging on a heap and a linked list.

A text is cut into pre-tokens; the symbols of a pre-token start as its bytes.
The adjacent pair with the lowest rank (leftmost among equals) is popped and
merged until no pair has a rank. The count is the number of symbols at the
start less the merges, so no identifiers are formed.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapwise.llm.common import slices

# Fixed value: the pre-token pattern of byte-level encoders of this family.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Entries that a worker remembers, and the longest piece it does; both only save time.
CACHE_PIECES, CACHE_CHARS = 1_500_000, 40
POSITION = (1 << 40) - 1


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in the vocabulary file."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in shown}
    letters.update({chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(shown))})
    return letters


class PairMerger:
    """Counts tokens of texts for one vocabulary file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, before = spec["model"], spec["pre_tokenizer"]
        plain = (
            model["type"] == "BPE" and not model.get("dropout") and not model.get("ignore_merges")
            and not model.get("continuing_subword_prefix") and not model.get("end_of_word_suffix")
            and spec.get("normalizer") is None and before["type"] == "ByteLevel" and before.get("use_regex", True)
            and not before.get("add_prefix_space")
            and not any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"])
        )
        if not plain:
            raise ValueError(f"{path} is not a plain byte-level pair encoder")
        letters = byte_letters()
        symbol: dict[bytes, int] = {bytes([b]): b for b in range(256)}
        ranks: dict[int, int] = {}
        self.merged: list[int] = []
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            a, b = (bytes(letters[c] for c in part) for part in (left, right))
            self.merged.append(symbol.setdefault(a + b, len(symbol)))
            ranks.setdefault(symbol[a] << 20 | symbol[b], rank)
        self.rank_of = ranks.get
        self.cut = regex.compile(PATTERN)
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(regex.escape(s) for s in sorted(special, key=len, reverse=True))) if special else None
        self.inner_space = regex.compile(r" (?=\S)")
        self.tokens: dict[str, int] = {}
        self.pieces: dict[str, int] = {}

    def count_token(self, token: str) -> int:
        """Symbols left of one pre-token."""
        found = self.tokens.get(token)
        if found is not None:
            return found
        symbols = list(token.encode("utf-8", "replace"))
        n = left = len(symbols)
        rank_of, merged = self.rank_of, self.merged
        # A heap entry is the rank above the position; it is stale if the pair there has another rank now.
        heap = []
        for i in range(n - 1):
            rank = rank_of(symbols[i] << 20 | symbols[i + 1])
            if rank is not None:
                heap.append(rank << 40 | i)
        if heap:
            heapify(heap)
            after = list(range(1, n + 1))
            before = list(range(-1, n - 1))
        while heap:
            entry = heappop(heap)
            i = entry & POSITION
            j = after[i]
            # A merged-away symbol is -1 and has no pairs.
            if j >= n or rank_of(symbols[i] << 20 | symbols[j]) != entry >> 40:
                continue
            new = symbols[i] = merged[entry >> 40]
            symbols[j] = -1
            left -= 1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                rank = rank_of(new << 20 | symbols[k])
                if rank is not None:
                    heappush(heap, rank << 40 | i)
            k = before[i]
            if k >= 0:
                rank = rank_of(symbols[k] << 20 | new)
                if rank is not None:
                    heappush(heap, rank << 40 | k)
        if len(token) <= CACHE_CHARS:
            if len(self.tokens) >= CACHE_PIECES:
                self.tokens.clear()
            self.tokens[token] = left
        return left

    def count_piece(self, piece: str) -> int:
        if piece[1:].isalpha() and piece[0] == " ":
            return self.count_token(piece)
        return sum(map(self.count_token, self.cut.findall(piece)))

    def count_plain(self, text: str) -> int:
        """Tokens of a text without special strings.

        A space before a character that is not white space always begins a
        pre-token, so the text falls into pieces there that count apart.
        """
        pieces = text.split(" ")
        seen = self.pieces
        total = self.count_piece(pieces[0])
        for i, piece in enumerate(pieces):
            if not i:
                continue
            n = seen.get(piece)
            if n is None:
                if not piece or piece[0].isspace():
                    break
                n = self.count_piece(" " + piece)
                if len(piece) <= CACHE_CHARS:
                    if len(seen) >= CACHE_PIECES:
                        seen.clear()
                    seen[piece] = n
            total += n
        else:
            return total
        # Runs of white space: cut only where a space stands before a character that is none.
        cuts = [0, *(m.start() for m in self.inner_space.finditer(text)), len(text)]
        return sum(self.count_piece(text[a:b]) for a, b in zip(cuts, cuts[1:]) if a < b)

    def count(self, text: str) -> int:
        if not text:
            return 0
        if self.special is None or not self.special.search(text):
            return self.count_plain(text)
        total, at = 0, 0
        for m in self.special.finditer(text):
            if m.start() > at:
                total += self.count_plain(text[at : m.start()])
            total += 1
            at = m.end()
        return total + (self.count_plain(text[at:]) if at < len(text) else 0)


# One merger per worker process and file.
_MERGERS: dict[str, PairMerger] = {}


def merger(path: str) -> PairMerger:
    if path not in _MERGERS:
        _MERGERS[path] = PairMerger(path)
    return _MERGERS[path]


def count_tokens(
    docs: DataFrame, path: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    Whole texts, without added begin or end tokens; special strings inside a
    text are one token each. A null or empty text has 0 of both. Null ids,
    repeated rows and other columns pass or are not read; an empty table gives
    no rows. `path` must exist on every executor.
    """
    kind = docs.schema[id_col].dataType
    schema = T.StructType(
        [T.StructField(id_col, kind), T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = merger(path).count
        for batch in slices(batches, 1):
            texts = batch.column(1)
            n_bytes = [n or 0 for n in pa.compute.binary_length(texts).to_pylist()]
            n_tokens = [count(t) for t in texts.to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64())],
                names=[id_col, "n_bytes", "n_tokens"],
            )

    rows = docs.select(id_col, F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("__text"))
    return rows.mapInArrow(run, schema).withColumn("over_limit", F.col("n_tokens") > limit)

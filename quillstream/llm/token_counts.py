"""Token counts of a byte-level BPE vocabulary by the whole-token shortcut.

A text is cut at the special strings and then into pre-tokens.  Merging never crosses a
pre-token, so a pre-token's number of tokens depends on it alone.  Offline, once per job,
every vocabulary string is merged on its own: those that end as one token are *proven*, and
a pre-token among them counts 1 without any merging.  Only the rest is merged, each distinct
one once per task as long as the memory of it (``MEMO``) lasts.
"""

from __future__ import annotations

import json
from collections import Counter

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the pre-token pattern of this kind of vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Distinct merged pre-tokens remembered by a task, and the longest of them.
MEMO = 400_000
MEMO_LENGTH = 64
LIMIT = 1024


def _byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in such vocabulary files."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Merger:
    """Ranks of the merges; counts the tokens of one pre-token."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        self.letters = _byte_letters()
        merges = (m.split(" ") if isinstance(m, str) else m for m in data["model"]["merges"])
        self.ranks = {(a, b): i for i, (a, b) in enumerate(merges)}
        self.special = [t["content"] for t in data["added_tokens"]]
        bytes_of = {c: b for b, c in self.letters.items()}
        # Strings that are not whole UTF-8 can't be a pre-token of a text.
        self.proven = set()
        for token in data["model"]["vocab"]:
            raw = bytes(bytes_of[c] for c in token)
            if self.count(raw) == 1:
                try:
                    self.proven.add(raw.decode())
                except UnicodeDecodeError:
                    continue

    def count(self, raw: bytes) -> int:
        """Tokens of a pre-token: merge the lowest rank, leftmost first, until none applies.

        A heap of possible merges over a linked list: n log n in the pre-token's length.
        """
        import heapq

        parts = [self.letters[b] for b in raw]
        n, ranks = len(parts), self.ranks
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), n
        heap = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1)
                if (r := ranks.get((parts[i], parts[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if parts[i] != a or j >= n or parts[j] != b:
                continue
            parts[i], parts[j] = a + b, None
            alive -= 1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                if (r := ranks.get((parts[i], parts[after[i]]))) is not None:
                    heapq.heappush(heap, (r, i, parts[i], parts[after[i]]))
            if (h := before[i]) >= 0 and (r := ranks.get((parts[h], parts[i]))) is not None:
                heapq.heappush(heap, (r, h, parts[h], parts[i]))
        return alive


def _counter(shared):
    def run(batches):
        merger: Merger = shared.value
        proven, memo = merger.proven, {}
        find = regex.compile(PATTERN).findall
        special = regex.compile("|".join(map(regex.escape, merger.special)) or r"(?!)")

        def tokens(text: str) -> int:
            specials, counts = 0, Counter()
            for k, part in enumerate(special.split(text)):
                specials += k > 0
                counts.update(find(part))
            total = specials
            for pre, times in counts.items():
                if pre in proven:
                    total += times
                    continue
                n = memo.get(pre)
                if n is None:
                    n = merger.count(pre.encode())
                    if len(pre) <= MEMO_LENGTH:
                        if len(memo) >= MEMO:
                            memo.clear()
                        memo[pre] = n
                total += n * times
            return total

        for batch in batches:
            counts = [tokens(x.as_py() or "") for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(counts, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"])
    return run


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row of ``docs``.

    Counts are those of the vocabulary's own library without added tokens; special
    strings inside a text count as one token.  Null and empty texts have 0 bytes and 0
    tokens.  Repeated rows are counted each; ids may be null; other columns are not read.
    The proven strings are broadcast: their number is bounded by the vocabulary.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Merger(vocabulary))
    rows = docs.select("doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    out = rows.mapInArrow(_counter(shared), f"doc_id {id_type}, n_bytes bigint, n_tokens bigint")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)

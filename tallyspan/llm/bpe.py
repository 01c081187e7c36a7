"""Byte-level BPE by speculation: propose tokens, verify, and merge only what fails.

Words (the file's pre-tokenizer) are proposed as their greedy longest matches in
the vocabulary. A proposal is the merges' own result exactly if no merge would
ever have crossed the border between two of its tokens. That is a matter of the
two tokens alone: before any merge crosses a border, both sides develop as if
they were alone. So each adjacent pair is tested by itself, and all pairs of a
block of words at once: walk back in time from the two finished tokens, undoing
whichever was made later, and look up at each step whether the two pieces that
then met would have merged before. Only words with a pair that fails undergo
exact merging. Tokens that the merges never make of their own bytes are left out
of the proposals.

The walk needs merges that make each token in one way, after its parts; a file
that breaks this, or has a normalizer, prefix spaces, dropout or other options
that change words, is an error.

Nothing is shuffled: tasks keep the words of late in a table of bounded size, and
take texts in blocks, so memory depends on the longest text alone.

Edge cases. Null text: as empty, no ids. Strings of added tokens stand for their
ids. Null ids decode to null, ids outside the vocabulary to nothing, bytes that
are no UTF-8 to U+FFFD. Repeated rows: each by itself. No rows: none. Other
columns stay, whatever their names; one that has the result's name is replaced.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tallyspan.llm.common import shipped, thrifty

#: The pre-tokenizer's pattern for words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words kept by a task, letters of text taken at once, bytes of a word up to
#: which merging looks at all its pairs.
KEPT, BLOCK, SHORT = 1 << 18, 1 << 22, 100
_NEVER = 1 << 40
_CODERS: dict[str, "Coder"] = {}


def _byte_of() -> dict[str, int]:
    """The byte that each letter of a byte-level file stands for: printable
    letters of Latin-1 are themselves, the others are numbered from 256."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(kept)]
    return {chr(b): b for b in kept} | {chr(256 + i): b for i, b in enumerate(others)}


class Coder:
    """Tables of a tokenizer file, and the words of late."""

    def __init__(self, path: str) -> None:
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre, added = spec["model"], spec.get("pre_tokenizer") or {}, spec.get("added_tokens") or []
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges") if model.get(k)]
        odd += [t["content"] for t in added if any(t.get(k) for k in ("single_word", "lstrip", "rstrip", "normalized"))]
        if model.get("type") != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True) or spec.get("normalizer") or odd:
            raise ValueError(f"{path} is no plain byte-level BPE file {odd}")
        byte_of = _byte_of()
        as_bytes = lambda t: bytes(byte_of[c] for c in t)
        vocab = model["vocab"]
        n = max([*vocab.values(), *(t["id"] for t in added)]) + 1
        self.text_of = [b""] * n
        for t, i in vocab.items():
            self.text_of[i] = as_bytes(t)
        for t in added:
            self.text_of[t["id"]] = t["content"].encode()
        self.added = {t["content"]: t["id"] for t in added}
        self.split = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")") if added else None
        self.words = regex.compile(WORDS)
        # What each token was merged from, and when. Bytes were never merged.
        self.left, self.right = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
        self.made = np.full(n, _NEVER)
        self.byte_ids = [vocab[c] for c in sorted(byte_of, key=byte_of.get)]
        self.made[self.byte_ids] = -1
        self.merges: dict[tuple[int, int], int] = {}
        self.result: list[int] = []
        for rank, pair in enumerate(model["merges"]):
            parts = pair.split(" ") if isinstance(pair, str) else pair
            a, b, new = vocab[parts[0]], vocab[parts[1]], vocab["".join(parts)]
            if self.made[new] != _NEVER or max(self.made[a], self.made[b]) >= rank:
                raise ValueError(f"merge {rank} makes a token anew, or of parts that come later")
            self.left[new], self.right[new], self.made[new] = a, b, rank
            self.merges[a, b] = rank
            self.result.append(new)
        keys = np.array([a << 32 | b for a, b in self.merges], np.int64)
        order = np.argsort(keys)
        self.pair_keys, self.pair_ranks = np.append(keys[order], -1), np.append(np.array([*self.merges.values()], np.int64)[order], _NEVER)
        self._own_tokens()
        self.seen: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _own_tokens(self) -> None:
        """The tokens that the merges make of their own bytes, by those bytes."""
        ids = np.flatnonzero(self.left >= 0)
        fine = np.zeros(len(self.made), bool)
        fine[self.byte_ids] = True
        joins = dict(zip(ids.tolist(), self.compatible(self.left[ids], self.right[ids], joined=True).tolist()))
        for i in ids[np.argsort(self.made[ids])].tolist():
            fine[i] = joins[i] and fine[self.left[i]] and fine[self.right[i]]
        self.ids = {self.text_of[i]: i for i in np.flatnonzero(fine).tolist()}
        self.longest: dict[bytes, int] = {}
        for t in self.ids:
            self.longest[t[:2]] = max(len(t), self.longest.get(t[:2], 1))

    def compatible(self, a: np.ndarray, b: np.ndarray, joined: bool = False) -> np.ndarray:
        """For each pair of tokens whether no merge crosses the border between
        them; with joined, none but that of the two whole tokens."""
        fine = np.ones(len(a), bool)
        at, x, y = np.arange(len(a)), a.astype(np.int64), b.astype(np.int64)
        before = np.full(len(a), 0 if joined else _NEVER)
        while len(at):
            key = x << 32 | y
            place = np.searchsorted(self.pair_keys[:-1], key)
            rank = np.where(self.pair_keys[place] == key, self.pair_ranks[place], _NEVER)
            crossed = rank < before
            fine[at[crossed]] = False
            going = ~crossed & ((self.made[x] >= 0) | (self.made[y] >= 0))
            at, x, y = at[going], x[going], y[going]
            # Of two made by one merge the left one came first, so a merge of
            # that rank between them would come before the right one's.
            first = self.made[x] > self.made[y]
            before = np.where(first, self.made[x], self.made[y] + 1)
            x, y = np.where(first, self.right[x], x), np.where(first, y, self.left[y])
        return fine

    def propose(self, word: bytes) -> list[int]:
        """Greedy longest matches."""
        if (whole := self.ids.get(word)) is not None:
            return [whole]
        out, i, n = [], 0, len(word)
        while i < n:
            m = min(n - i, self.longest.get(word[i : i + 2], 1))
            while m > 1 and word[i : i + m] not in self.ids:
                m -= 1
            out.append(self.ids[word[i : i + m]])
            i += m
        return out

    def merged(self, word: bytes) -> list[int]:
        """Exact merging: always the pair of least rank, the leftmost of equals."""
        ids, get = [self.byte_ids[b] for b in word], self.merges.get
        if len(ids) > SHORT:
            return self._merged_long(ids)
        ranks = [get(pair, _NEVER) for pair in zip(ids, ids[1:])]
        while ranks and (rank := min(ranks)) != _NEVER:
            i = ranks.index(rank)
            ids[i : i + 2] = [self.result[rank]]
            del ranks[i]
            if i:
                ranks[i - 1] = get((ids[i - 1], ids[i]), _NEVER)
            if i < len(ranks):
                ranks[i] = get((ids[i], ids[i + 1]), _NEVER)
        return ids

    def _merged_long(self, ids: list[int]) -> list[int]:
        """The same by a heap of pairs, for words of any length."""
        n, get = len(ids), self.merges.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(rank, i, *pair) for i, pair in enumerate(zip(ids, ids[1:])) if (rank := get(pair)) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue  # one of the two was merged meanwhile
            ids[i], ids[j] = self.result[rank], -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
            for p, q in ((before[i], i), (i, k)):
                if p >= 0 and q < n and (found := get((ids[p], ids[q]))) is not None:
                    heapq.heappush(heap, (found, p, ids[p], ids[q]))
        return [i for i in ids if i >= 0]

    def learn(self, words: set[str]) -> None:
        """Ids of these words into the table. A full one becomes the older one,
        whose words come back when they are met again."""
        if len(self.seen) + len(words) > KEPT:
            self.seen, self.older = {}, self.seen
        met = words & self.older.keys()
        self.seen.update((w, self.older[w]) for w in met)
        new = [w for w in words - met if w not in self.seen]
        if not new:
            return
        raw = [w.encode("utf-8", "replace") for w in new]
        proposed = [self.propose(w) for w in raw]
        size = np.array([len(p) for p in proposed])
        flat = np.array([i for p in proposed for i in p], np.int64)
        # Neighbours in flat are a pair unless a word ends between them.
        ends = np.cumsum(size)
        inside = np.ones(max(len(flat) - 1, 0), bool)
        inside[ends[:-1] - 1] = False
        at = np.flatnonzero(inside)
        pairs, which = np.unique(flat[at] << 32 | flat[at + 1], return_inverse=True)
        bad = ~self.compatible(pairs >> 32, pairs & 0xFFFFFFFF)[which]
        for k in np.unique(np.searchsorted(ends, at[bad], side="right")).tolist():
            proposed[k] = self.merged(raw[k])
        packed = np.array([i for p in proposed for i in p], "<u4").tobytes()
        stops = (4 * np.cumsum([len(p) for p in proposed])).tolist()
        for w, i, j in zip(new, [0, *stops], stops):
            self.seen[w] = packed[i:j]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as four bytes each."""
        out: list[bytes] = []
        start = 0
        while start < len(texts):
            size, end = 0, start
            while end < len(texts) and (end == start or size + len(texts[end]) <= BLOCK):
                size += len(texts[end])
                end += 1
            out += self._block(texts[start:end])
            start = end
        return out

    def _block(self, texts: list[str]) -> list[bytes]:
        if sum(map(len, texts)) > BLOCK:
            return [b"".join(self._pieces(t)) for t in texts]
        cut = [self._cut(t) for t in texts]
        self.learn({w for parts in cut for w, i in parts if i is None for w in w})
        get = self.seen.__getitem__
        return [b"".join([np.array([i], "<u4").tobytes() if i is not None else b"".join(map(get, w)) for w, i in parts]) for parts in cut]

    def _cut(self, text: str) -> list[tuple[list[str], int | None]]:
        """Runs of words, and added tokens by their ids."""
        if self.split is None or not any(t in text for t in self.added):
            return [(self.words.findall(text), None)]
        return [([], self.added[x]) if x in self.added else (self.words.findall(x), None) for x in self.split.split(text) if x]

    def _pieces(self, text: str) -> Iterator[bytes]:
        """A long text's ids, some words at a time."""
        for x in self.split.split(text) if self.split else [text]:
            if x in self.added:
                yield np.array([self.added[x]], "<u4").tobytes()
                continue
            found = (m[0] for m in self.words.finditer(x))
            while some := list(islice(found, KEPT)):
                self.learn(set(some))
                yield b"".join(map(self.seen.__getitem__, some))

    def decode(self, ids: list[int]) -> str:
        """Text of ids that all are in the vocabulary."""
        return b"".join(map(self.text_of.__getitem__, ids)).decode("utf-8", "replace")


def coder(path: str) -> Coder:
    """The coder of this worker, kept between tasks; path: a file, or the name of
    a public one."""
    if path not in _CODERS:
        import public_tokenizers

        _CODERS[path] = Coder(path if "/" in path else public_tokenizers.path(path))
    return _CODERS[path]


def _with(df: DataFrame, column: str, kind: T.DataType) -> T.StructType:
    return T.StructType([f for f in df.schema.fields if f.name != column] + [T.StructField(column, kind)])


def _appended(batch: pa.RecordBatch, column: str, values: pa.Array) -> pa.RecordBatch:
    names = [c for c in batch.schema.names if c != column]
    return pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), values], names=[*names, column])


@shipped
def encode(docs: DataFrame, path: str = "byte_bpe_50k.json", *, text: str = "text", out: str = "ids") -> DataFrame:
    """docs with the ids of a text column in an array column of integers, as the
    tokenizers library has them without special tokens put round the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(path)
        for batch in batches:
            packed = own.encode([t or "" for t in batch.column(text).to_pylist()])
            at = np.cumsum([0, *(len(p) // 4 for p in packed)]).astype(np.int32)
            flat = np.frombuffer(b"".join(packed), "<u4").astype(np.int32)
            yield _appended(batch, out, pa.ListArray.from_arrays(pa.array(at), pa.array(flat)))

    return docs.mapInArrow(thrifty(run), _with(docs, out, T.ArrayType(T.IntegerType())))


@shipped
def decode(docs: DataFrame, path: str = "byte_bpe_50k.json", *, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """docs with the text of an array column of ids, added tokens as their strings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(path)
        n = len(own.text_of)
        for batch in batches:
            rows = batch.column(ids)
            flat = rows.values.cast(pa.int64()).fill_null(-1).to_numpy(zero_copy_only=False)
            known = (flat >= 0) & (flat < n)
            stops = np.append(0, np.cumsum(known))[rows.offsets.to_numpy()].tolist()
            flat = flat[known]
            texts = (own.decode(flat[i:j].tolist()) if there else None for i, j, there in zip(stops, stops[1:], rows.is_valid().to_pylist()))
            yield _appended(batch, out, pa.array(texts, pa.string()))

    return docs.mapInArrow(thrifty(run), _with(docs, out, T.StringType()))

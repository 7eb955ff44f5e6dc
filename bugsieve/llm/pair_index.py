"""Byte-level BPE by an index from pairs to their positions, one rank after another."""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterable, Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bugsieve.llm.common import appended, free_names, per_worker, release_memory

#: Rows encoded together, characters of their texts at most (but for one longer text), and words
#: of such a text that are held at a time.
ROWS, TEXT_CHARS, TEXT_WORDS = 2_500, 8_000_000, 500_000
#: Distinct words a worker remembers, and the bytes of the longest it does.
MEMO_WORDS, MEMO_BYTES = 250_000, 256
#: Bytes of new words that one index covers, but for one longer word: some 40 bytes of memory each.
INDEX_BYTES = 4_000_000

# Fixed value: the split pattern of byte-level vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _byte_chars() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabulary files: printable ones for
    themselves, the others from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


class _Memo(dict):
    """Ids of remembered words; those of the long ones of a lot stand in ``long``."""

    long: dict[str, bytes]

    def __missing__(self, word: str) -> bytes:
        return self.long[word]


class Codec:
    """Merges, vocabulary and remembered words of one ``tokenizer.json``."""

    def __init__(self, path: str, memo_words: int = MEMO_WORDS, index_bytes: int = INDEX_BYTES) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, split = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or split["type"] != "ByteLevel" or spec.get("normalizer"):
            raise ValueError("only byte-level BPE without a normalizer is known")
        if split.get("add_prefix_space") or not split.get("use_regex", True) or model.get("ignore_merges"):
            raise ValueError("prefix spaces, other splits and whole-word lookups are not known")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("added tokens that take in their surroundings are not known")
        vocab = model["vocab"]
        chars = _byte_chars()
        self.byte_id = np.full(256, -1, dtype=np.int32)
        for c, b in chars.items():
            self.byte_id[b] = vocab[c]
        self.piece = {i: bytes(chars[c] for c in t) if all(c in chars for c in t) else t.encode() for t, i in vocab.items()}
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.piece |= {i: t.encode() for t, i in self.added.items()}
        longest = sorted(self.added, key=len, reverse=True)
        self.specials = regex.compile("|".join(map(regex.escape, longest))) if longest else None
        self.pattern = regex.compile(PATTERN)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.left = np.array([vocab[a] for a, _ in pairs], dtype=np.int64)
        self.right = np.array([vocab[b] for _, b in pairs], dtype=np.int64)
        self.made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int32)
        born = {int(t): -1 for t in self.byte_id}
        for rank, (a, b, t) in enumerate(zip(self.left.tolist(), self.right.tolist(), self.made.tolist(), strict=True)):
            if a not in born or b not in born:
                raise ValueError("a merge uses a token that a later one makes: ranks cannot be applied in order")
            born.setdefault(t, rank)
        keys = (self.left << 32) | self.right
        self.order = np.argsort(keys, kind="stable")
        self.keys = keys[self.order]
        self.memo = _Memo()
        self.memo_words, self.index_bytes = memo_words, index_bytes

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of each pair of tokens, -1 where it has none."""
        key = (a.astype(np.int64) << 32) | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.order[at], -1)

    def contract(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word, all words contracted together.

        The index maps a pair's rank to the positions (of its left token) where the pair stands,
        in whatever word. A merge only makes pairs of higher rank, since its token is used by later
        merges alone, so one ascending pass over the ranks that have positions does for every word
        what leftmost-least contraction does for it alone. Positions whose pair has been broken
        meanwhile are passed over; of those that overlap (runs of one token), the leftmost counts.
        """
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        starts = np.cumsum(lengths) - lengths
        tok = self.byte_id[np.frombuffer(b"".join(words), dtype=np.uint8)]
        n = len(tok)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        after[starts + lengths - 1] = -1
        before[starts] = -1
        index: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def enter(at: np.ndarray) -> None:
            ranks = self._ranks(tok[at], tok[after[at]])
            at, ranks = at[ranks >= 0], ranks[ranks >= 0]
            if not len(at):
                return
            order = np.argsort(ranks, kind="stable")
            at, ranks = at[order], ranks[order]
            cuts = [0, *(np.flatnonzero(np.diff(ranks)) + 1).tolist(), len(ranks)]
            for rank, a, b in zip(ranks[cuts[:-1]].tolist(), cuts[:-1], cuts[1:], strict=True):
                if rank in index:
                    index[rank].append(at[a:b])
                else:
                    index[rank] = [at[a:b]]
                    heapq.heappush(active, rank)

        enter(np.flatnonzero(after >= 0))
        while active:
            rank = heapq.heappop(active)
            lists = index.pop(rank)
            a, b = self.left[rank], self.right[rank]
            at = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
            at = at[(tok[at] == a) & (after[at] >= 0)]
            at = at[tok[after[at]] == b]
            if a == b and len(at) > 1:  # every second of those that overlap
                at = np.unique(at)
                place = np.arange(len(at))
                run = np.maximum.accumulate(np.where(np.r_[True, after[at[:-1]] != at[1:]], place, 0))
                at = at[(place - run) % 2 == 0]
            if not len(at):
                continue
            gone = after[at]
            beyond = after[gone]
            tok[at], tok[gone] = self.made[rank], -1
            after[at] = beyond
            more = beyond >= 0
            before[beyond[more]] = at[more]
            ahead = before[at]
            enter(np.unique(np.concatenate([ahead[ahead >= 0], at[more]])))
        kept = tok >= 0
        ends = np.cumsum(kept)[starts + lengths - 1].tolist() if n else []
        data = tok[kept].astype("<i4").tobytes()
        return [data[4 * a : 4 * b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]

    def _learn(self, words: list[str]) -> None:
        """Remember the ids of new words; long ones go to ``self.long``, which lasts for a lot."""
        lot, size = [], 0
        for word in (*words, None):
            data = None if word is None else word.encode()
            if lot and (data is None or size + len(data) > self.index_bytes):
                for w, ids in zip((w for w, _ in lot), self.contract([d for _, d in lot]), strict=True):
                    (self.memo if len(w) <= MEMO_BYTES else self.long)[w] = ids
                lot, size = [], 0
            if data is not None:
                lot.append((word, data))
                size += len(data)

    def _words(self, text: str) -> list[str] | Iterator[str]:
        """The text's words, added tokens among them with ``_MARK`` before them."""
        found = [*self.specials.finditer(text)] if self.specials else []
        if not found and len(text) <= TEXT_CHARS:
            return self.pattern.findall(text)
        edges = [0, *(x for m in found for x in m.span()), len(text)]
        parts = (text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
        marks = [*([_MARK + m.group()] for m in found), []]
        return chain.from_iterable(
            chain((m.group() for m in self.pattern.finditer(part)), mark) for part, mark in zip(parts, marks, strict=True)
        )

    def _ids(self, split: list[list[str]], distinct: Iterable[str]) -> list[bytes]:
        """The ids of each list of words; the distinct new words of all make one lot."""
        memo = self.memo
        new = [w for w in distinct if w not in memo and w[0] != _MARK]
        if len(memo) + len(new) > self.memo_words:
            memo.clear()
            new = [w for w in distinct if w[0] != _MARK]
        memo.long = self.long = {_MARK + t: i.to_bytes(4, "little") for t, i in self.added.items()}
        self._learn(new)
        return [b"".join(map(memo.__getitem__, words)) for words in split]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit numbers."""
        out: list[bytes] = []
        at = 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and (end == at or size + len(texts[end]) <= TEXT_CHARS):
                size += len(texts[end])
                end += 1
            if size > TEXT_CHARS:  # one very long text, some of its words at a time
                words, parts = iter(self._words(texts[at])), []
                while some := list(islice(words, TEXT_WORDS)):
                    parts += self._ids([some], set(some))
                out.append(b"".join(parts))
            else:
                same: dict[str, str] = {}  # one object for a word, wherever it stands
                split = []
                for text in texts[at:end]:
                    words = list(self._words(text))
                    split.append(list(map(same.setdefault, words, words)))
                out += self._ids(split, same)
            at = end
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of ids; unknown ids have none, bytes that are not UTF-8 become U+FFFD."""
        return b"".join(map(self.piece.get, ids, _NOTHING)).decode("utf-8", "replace")


class _Empty:
    def __iter__(self) -> Iterator[bytes]:
        while True:
            yield b""


#: The empty piece, for every id that the vocabulary has not got.
_NOTHING = _Empty()
#: Before an added token among the words; no word has it, since Spark's strings hold no surrogates.
_MARK = "\ud800"


def _codec(path: str) -> Codec:
    return per_worker(f"pair index {path}", lambda: Codec(path))


def _lists(ids: list[bytes]) -> pa.Array:
    ends = np.cumsum([0, *(len(x) // 4 for x in ids)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(ids), dtype="<i4")))


def encode(docs: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """The rows with the token ids of each whole text as an array<int>, as the library encodes with
    the ``tokenizer.json`` at ``path`` (on every executor) and no special tokens added; an added
    token that stands in a text is that token, as there.

    The distinct new words of some rows make one lot, whose pair index (see ``Codec.contract``) is
    contracted rank by rank. Workers remember a bounded number of words. A null text is an empty
    one, which has no ids; repeated rows stay; an empty table gives no rows; a column named
    ``ids_col`` in ``docs`` gives way. No shuffle: a lost task is encoded again.
    """
    return _with_ids(docs, path, text_col, ids_col, None)


def round_trip(
    docs: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids", decoded_col: str = "decoded"
) -> DataFrame:
    """``encode`` and ``decode`` of its ids in one pass, by one worker."""
    return _with_ids(docs, path, text_col, ids_col, decoded_col)


def _with_ids(docs: DataFrame, path: str, text_col: str, ids_col: str, decoded_col: str | None) -> DataFrame:
    rows = docs.drop(ids_col, *([decoded_col] if decoded_col else []))
    (given,) = free_names(rows, "given_")
    rows = rows.withColumn(given, F.coalesce(F.col(f"`{text_col}`"), F.lit("")))

    def work(texts: pa.Array) -> list[pa.Array]:
        codec = _codec(path)
        ids = codec.encode(texts.to_pylist())
        made = [_lists(ids)]
        if decoded_col:
            made.append(pa.array((codec.decode(np.frombuffer(x, dtype="<i4").tolist()) for x in ids), type=pa.string()))
        return made

    fields = [T.StructField(ids_col, T.ArrayType(T.IntegerType()))]
    if decoded_col:
        fields.append(T.StructField(decoded_col, T.StringType()))
    return appended(rows, [given], fields, work, ROWS).drop(given)


def decode(tokens: DataFrame, path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """The rows with the text that each list of ids stands for, special tokens included; null lists
    and null or unknown ids have no text; a column named ``text_col`` gives way."""
    rows = tokens.drop(text_col)

    def work(ids: pa.Array) -> list[pa.Array]:
        codec = _codec(path)
        out = []
        for x in ids:
            out.append(codec.decode(x.values.drop_null().to_numpy().tolist()) if x.is_valid else "")
        release_memory()
        return [pa.array(out, type=pa.string())]

    return appended(rows, [ids_col], [T.StructField(text_col, T.StringType())], work, ROWS)


def ids_text(ids: Column) -> Column:
    """Decimal ids joined by commas."""
    return F.concat_ws(",", ids.cast("array<string>"))

"""Byte-level BPE by recursive queries in DuckDB, one small database per Python worker."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bugsieve.llm.common import per_worker

#: Encoded words a worker remembers; it starts again when they would be more.
MEMO_WORDS = 400_000
#: Characters of text, bytes of new words and tokens that one query sees at most, but for one
#: text or word that is longer by itself.
TEXT_CHARS, WORD_BYTES, DECODE_TOKENS = 4_000_000, 400_000, 1_000_000
#: Rounds of one recursive query, which keeps the rows of all its rounds; longer contractions
#: go on in another query.
ROUNDS = 48
#: Words of more bytes contract all places of their pair in a round where that changes nothing.
LONG_WORD = 48

# A row is a token: word, place in the word, the token before it, the token, and the rank of the
# two as a pair. A round finds the least rank and its leftmost place in every word that has a
# rank; the token there vanishes, the one before it becomes the merged token (whose id is the
# rank), and ranks are looked up anew.
_ROUND_ONE = """
WITH RECURSIVE t(it, w, idx, prev, tok, rank) AS (
  SELECT 0, s.w, s.idx, s.prev, s.tok, m.rank
  FROM state s LEFT JOIN merges m ON m.pair = s.prev::BIGINT * 4294967296 + s.tok
  UNION ALL
  SELECT n.it, n.w, n.idx, n.prev, n.tok, m.rank FROM (
    SELECT t.it + 1 AS it, t.w, t.idx - (t.idx > b.p)::INT AS idx,
           CASE WHEN t.idx = b.p + 1 THEN b.r ELSE t.prev END AS prev,
           CASE WHEN t.idx = b.p - 1 THEN b.r ELSE t.tok END AS tok
    FROM t JOIN (
      SELECT w, (k & 4294967295)::INT AS p, (k >> 32)::INT AS r
      FROM (SELECT w, min(rank::BIGINT * 4294967296 + idx) AS k FROM t WHERE rank IS NOT NULL GROUP BY w)
    ) b USING (w)
    WHERE t.idx <> b.p AND t.it < {rounds}
  ) n LEFT JOIN merges m ON m.pair = n.prev::BIGINT * 4294967296 + n.tok
)"""

# The same with all places of the pair. Nothing can come between them if no token of lower rank
# begins or ends with the merged one (`safe`); of places that overlap, every second is taken.
_ROUND_ALL = """
WITH RECURSIVE t(it, w, idx, prev, tok, rank) AS (
  SELECT 0, s.w, s.idx, s.prev, s.tok, m.rank
  FROM state s LEFT JOIN merges m ON m.pair = s.prev::BIGINT * 4294967296 + s.tok
  UNION ALL
  SELECT n.it, n.w, n.idx, n.prev, n.tok, m.rank FROM (
    SELECT it + 1 AS it, w, idx - gone AS idx,
           CASE WHEN after_gone THEN r ELSE prev END AS prev,
           CASE WHEN before_gone THEN r ELSE tok END AS tok
    FROM (
      SELECT *, (sum(pick::INT) OVER o)::INT AS gone,
             coalesce(lag(pick) OVER o, false) AS after_gone, coalesce(lead(pick) OVER o, false) AS before_gone
      FROM (
        SELECT *, here AND (idx = p OR (safe AND (idx - min(idx) OVER (PARTITION BY w, here, run)) % 2 = 0)) AS pick
        FROM (
          SELECT t.*, b.p, b.r, b.safe, coalesce(t.rank = b.r, false) AS here,
                 t.idx - row_number() OVER (PARTITION BY t.w, coalesce(t.rank = b.r, false) ORDER BY t.idx) AS run
          FROM t JOIN (
            SELECT k.w, (k.k & 4294967295)::INT AS p, (k.k >> 32)::INT AS r, u.id IS NULL AS safe
            FROM (SELECT w, min(rank::BIGINT * 4294967296 + idx) AS k FROM t WHERE rank IS NOT NULL GROUP BY w) k
            LEFT JOIN unsafe u ON u.id = (k.k >> 32)::INT
          ) b USING (w)
          WHERE t.it < {rounds}
        )
      )
      WINDOW o AS (PARTITION BY w ORDER BY idx)
    )
    WHERE NOT pick
  ) n LEFT JOIN merges m ON m.pair = n.prev::BIGINT * 4294967296 + n.tok
)"""

_LAST = """
SELECT t.w, t.idx, t.prev, t.tok, l.more FROM t
JOIN (SELECT w, it, bool_or(rank IS NOT NULL) AS more FROM t
      WHERE (w, it) IN (SELECT (w, max(it)) FROM t GROUP BY w) GROUP BY w, it) l
ON l.w = t.w AND l.it = t.it ORDER BY t.w, t.idx"""

_DECODE = """
SELECT i.doc, string_agg(v.piece, '' ORDER BY i.pos) AS text
FROM ids i JOIN vocab v USING (id) GROUP BY i.doc"""


class Codec:
    """Merge table, vocabulary and remembered words of one rank file."""

    def __init__(self, ranks_path: str, pattern: str, memo_words: int = MEMO_WORDS) -> None:
        with open(ranks_path, "rb") as file:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file) if a}
        self.pattern = regex.compile(pattern)
        self.memo: dict[str, bytes] = {}
        self.memo_words = memo_words
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "600MB", "temp_directory": ""})
        self.byte_id = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        left, right, rank, unsafe = [], [], [], set()
        for piece, r in self.ranks.items():
            for i in range(1, len(piece)):
                a, b = self.ranks.get(piece[:i]), self.ranks.get(piece[i:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    rank.append(r)
                unsafe.update(x for x in (a, b) if x is not None and x > r)
        # Neighbouring bytes that some token holds: a word falls into parts between all others.
        self.together = np.zeros((256, 256), dtype=bool)
        for piece in self.ranks:
            data = np.frombuffer(piece, dtype=np.uint8)
            self.together[data[:-1], data[1:]] = True
        self._table("merges", {
            "pair": pa.array((np.array(left, dtype=np.int64) << 32) + np.array(right, dtype=np.int64)),
            "rank": pa.array(np.array(rank, dtype=np.int32)),
        })
        self._table("vocab", {
            "id": pa.array(list(self.ranks.values()), type=pa.int32()),
            "piece": pa.array([x.decode("latin-1") for x in self.ranks]),  # one character a byte
        })
        self._table("unsafe", {"id": pa.array(sorted(unsafe), type=pa.int32())})

    def _table(self, name: str, columns: dict) -> None:
        self.con.register("given", pa.table(columns))
        self.con.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
        self.con.unregister("given")

    def _contract(self, words: list[bytes], query: str) -> list[bytes]:
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        starts = np.cumsum(lengths) - lengths
        tok = self.byte_id[np.frombuffer(b"".join(words), dtype=np.uint8)]
        prev = np.r_[np.int32(-1), tok[:-1]]
        prev[starts] = -1
        state = pa.table({
            "w": pa.array(np.repeat(np.arange(len(words), dtype=np.int32), lengths)),
            "idx": pa.array((np.arange(len(tok)) - np.repeat(starts, lengths)).astype(np.int32)),
            "prev": pa.array(prev), "tok": pa.array(tok),
        })
        out: list[bytes] = [b""] * len(words)
        while state.num_rows:
            self.con.register("state", state)
            got = self.con.sql(query.format(rounds=ROUNDS) + _LAST).to_arrow_table()
            self.con.unregister("state")
            done = got.filter(pa.compute.invert(got["more"]))
            w, ids = done["w"].to_numpy(), done["tok"].to_numpy().astype("<u4")
            if len(w):
                cuts = np.r_[0, np.flatnonzero(np.diff(w)) + 1, len(w)]
                data = ids.tobytes()
                for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                    out[w[a]] = data[4 * a : 4 * b]
            state = got.filter(got["more"]).select(["w", "idx", "prev", "tok"])
        return out

    def parts_of(self, word: bytes) -> list[bytes]:
        """A word cut where no token holds both neighbours. Nothing is ever merged across such a place,
        so the parts contract apart."""
        data = np.frombuffer(word, dtype=np.uint8)
        cuts = [0, *(np.flatnonzero(~self.together[data[:-1], data[1:]]) + 1).tolist(), len(word)]
        return [word[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    def learn(self, words: list[str]) -> None:
        """Remember the ids of words; one that is itself a token is that token, a long one is its parts."""
        whole: dict[str, list[str]] = {}
        for word in words:
            if len(word) > LONG_WORD:
                parts = self.parts_of(word.encode())
                if len(parts) > 1:
                    whole[word] = [p.decode("latin-1") for p in parts]
        if whole:
            distinct = {p for parts in whole.values() for p in parts}
            ids = dict(zip(distinct, self._contracted([p.encode("latin-1") for p in distinct]), strict=True))
            self.memo.update((w, b"".join(map(ids.__getitem__, parts))) for w, parts in whole.items())
        rest = []
        for word in words:
            rank = self.ranks.get(word.encode())
            if rank is not None:
                self.memo[word] = rank.to_bytes(4, "little")
            elif word not in whole:
                rest.append(word)
        self.memo.update(zip(rest, self._contracted([w.encode() for w in rest]), strict=True))

    def _contracted(self, words: list[bytes]) -> list[bytes]:
        """The ids of words given by their bytes, a bounded number of bytes at a time."""
        out: list[bytes] = [b""] * len(words)
        lots: dict[bool, list[list]] = {False: [[], [], 0], True: [[], [], 0]}

        def close(long: bool) -> None:
            places, data, _ = lots[long]
            if data:
                for i, ids in zip(places, self._contract(data, _ROUND_ALL if long else _ROUND_ONE), strict=True):
                    out[i] = ids
            lots[long] = [[], [], 0]

        for i, data in enumerate(words):
            long = len(data) > LONG_WORD
            lots[long][0].append(i)
            lots[long][1].append(data)
            lots[long][2] += len(data)
            if lots[long][2] >= WORD_BYTES:
                close(long)
        close(False)
        close(True)
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers."""
        out: list[bytes] = []
        at = 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and (end == at or size + len(texts[end]) <= TEXT_CHARS):
                size += len(texts[end])
                end += 1
            split = [self.pattern.findall(x) for x in texts[at:end]]
            memo = self.memo
            new = {w for words in split for w in words if w not in memo}
            if len(memo) + len(new) > self.memo_words:
                memo.clear()
                new = {w for words in split for w in words}
            self.learn(list(new))
            out += [b"".join(map(memo.__getitem__, words)) for words in split]
            at = end
        return out

    def decode(self, ids: list[bytes]) -> list[bytes]:
        """The bytes that each list of ids stands for."""
        out: list[bytes] = [b""] * len(ids)
        at = 0
        while at < len(ids):
            end, size = at, 0
            while end < len(ids) and (end == at or size + len(ids[end]) // 4 <= DECODE_TOKENS):
                size += len(ids[end]) // 4
                end += 1
            lengths = [len(x) // 4 for x in ids[at:end]]
            self.con.register("ids", pa.table({
                "doc": pa.array(np.repeat(np.arange(end - at, dtype=np.int32), lengths)),
                "pos": pa.array(np.arange(size, dtype=np.int32)),
                "id": pa.array(np.frombuffer(b"".join(ids[at:end]), dtype="<u4").astype(np.int32)),
            }))
            for doc, text in self.con.execute(_DECODE).fetchall():
                out[at + doc] = text.encode("latin-1")
            self.con.unregister("ids")
            at = end
        return out


def _codec(ranks_path: str, pattern: str) -> Codec:
    return per_worker(f"codec {ranks_path} {pattern}", lambda: Codec(ranks_path, pattern))


def _apply(frame: DataFrame, id_col: str, source: DataFrame, outputs: list[str], work) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                made = work(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(x, type=pa.binary()) for x in made)], names=[id_col, *outputs]
                )

    schema = T.StructType(
        [T.StructField(id_col, source.schema[0].dataType), *(T.StructField(x, T.BinaryType()) for x in outputs)]
    )
    return source.mapInArrow(run, schema)


def bpe_encode(
    docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id_col, ids): the ids of each row's whole text as little-endian unsigned 32-bit numbers.

    Each match of ``pattern`` is a word; a word's bytes contract, leftmost pair of least rank
    first, until no pair has a rank. Special tokens are ordinary text. Null and empty texts have
    no ids; repeated rows stay; an empty table gives no rows; other columns are ignored.
    """
    rows = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")))
    return _apply(docs, id_col, rows, ["ids"], lambda texts: [_codec(ranks_path, pattern).encode(texts)])


def bpe_decode(
    tokens: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids"
) -> DataFrame:
    """(id_col, decoded): the bytes that each row's ids stand for; null ids give no bytes."""
    rows = tokens.select(F.col(id_col), F.coalesce(F.col(ids_col), F.lit(b"")))
    return _apply(tokens, id_col, rows, ["decoded"], lambda ids: [_codec(ranks_path, pattern).decode(ids)])


def bpe_round_trip(
    docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id_col, ids, decoded): ``bpe_encode`` and ``bpe_decode`` of its ids in one pass."""

    def work(texts: list[str]) -> list[list[bytes]]:
        codec = _codec(ranks_path, pattern)
        ids = codec.encode(texts)
        return [ids, codec.decode(ids)]

    rows = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")))
    return _apply(docs, id_col, rows, ["ids", "decoded"], work)

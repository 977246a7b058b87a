"""Best-fit packing of token pieces with lower bounds per partition.

Documents become pieces of at most ``CAPACITY`` tokens. Full pieces are sequences already.
The others are dealt to partitions of about ``PART_PIECES`` pieces and packed there by
best-fit decreasing. Dual feasible functions give each partition a lower bound of its bins:
where bins and bound agree the partition is certified and final. A partition with a gap keeps
its full bins and gives the documents of its open ones back; those of all such partitions are
dealt anew into fewer partitions and packed again, until nothing is left open, one partition
held everything, or ``ROUNDS`` rounds are over.

Only (id, length) rows are packed; token ids never leave the task that made them, except as
the checksum of each piece.

Edge cases: null and empty texts are the document of the end id alone; rows that repeat an id
are documents of their own; an empty table gives no pieces; further columns are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tipoff.llm.text import releasing
from tipoff.session import materialize

CAPACITY = 2048
END_ID = 0
PART_PIECES = 50_000
ROUNDS = 4
# Letters without marks of their own in any other form, and signs that never join letters.
SMALL = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, [*range(0xDF, 0xF7), *range(0xF8, 0xFF)]))
LARGE = "ABCDEFGHIJKLMNOPQRSTUVWXYZ" + "".join(map(chr, [*range(0xC0, 0xD7), *range(0xD8, 0xDF)]))
TAIL = ".,;:!?*%&$#"
PLAIN = re.compile(f"([{SMALL}{LARGE}]+)([{TAIL}]*)").fullmatch
CACHE_WORDS = 400_000
VOCABULARY = "word_bpe_49k.json"


class WordIds:
    """Little-endian 32-bit ids of blank-free strings, each encoded once as long as it is held.

    The tokenizer's rules never look across white space, so ids of a text are those of its
    blank-separated parts in order. Only blanks that every reader agrees on are cut at.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {}
        # Where the tokenizer's rules only fold letters and part them from what follows, letters
        # go to its model at once, as the signs that stand for their bytes.
        self.signs: dict[int, str] | None = None
        rules, whole = self.tokenizer, "".join(x + y for x in SMALL for y in SMALL)
        as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        if rules.normalizer and rules.pre_tokenizer:
            folds = rules.normalizer.normalize_str(whole + LARGE + TAIL) == whole + LARGE.lower() + TAIL
            cut = [x[0] for x in rules.pre_tokenizer.pre_tokenize_str(whole + TAIL)]
            want = [x[0] for x in (*as_bytes.pre_tokenize_str(whole), *rules.pre_tokenizer.pre_tokenize_str(TAIL))]
            if folds and cut == want:
                self.signs = {ord(c): as_bytes.pre_tokenize_str(c)[0][0] for c in SMALL}

    def _add(self, words: Iterable[str]) -> None:
        words = list(words)
        for at in range(0, len(words), 4096):
            some = words[at : at + 4096]
            for word, found in zip(some, self.tokenizer.encode_batch_fast(some, add_special_tokens=False)):
                self.known[word] = array("I", found.ids).tobytes()

    def _learn(self, new: set[str]) -> None:
        """Encode words that are not held; stems without what follows them are held beside them."""
        if not self.signs:
            return self._add(new)
        known, signs, tokenize = self.known, self.signs, self.tokenizer.model.tokenize
        cut, rest = [], []
        for word in new:
            if word.isascii() and word.isalpha():
                cut.append((word, word if word.islower() else word.lower(), ""))
            elif m := PLAIN(word):
                cut.append((word, m[1].lower(), m[2]))
            else:
                rest.append(word)
        self._add({tail for _, _, tail in cut}.union(rest).difference(known))
        for word, stem, tail in cut:
            ids = known.get(stem)
            if ids is None:
                found = tokenize(stem if stem.isascii() else stem.translate(signs))
                ids = known[stem] = array("I", [x.id for x in found]).tobytes()
            if tail:
                known[word] = ids + known[tail]
            elif word is not stem:
                known[word] = ids

    def of(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of every text; words that are new to all of them are encoded together."""
        words = [t.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ") for t in texts]
        if len(self.known) >= CACHE_WORDS:
            self.known.clear()
        known = self.known
        held = [list(map(known.get, own)) for own in words]
        self._learn({w for own, ids in zip(words, held) for w, x in zip(own, ids) if x is None})
        for own, ids in zip(words, held):
            yield b"".join([known[w] if x is None else x for w, x in zip(own, ids)])


_HELD: dict[str, WordIds] = {}


def token_ids(texts: list[str], vocabulary: str) -> Iterator[bytes]:
    """Ids of every text, as little-endian 32-bit numbers; a Python worker keeps the words it knows."""
    if vocabulary not in _HELD:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core
        _HELD[vocabulary] = WordIds(vocabulary)
    return _HELD[vocabulary].of(texts)


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """(doc_id, row, piece, start, length, ids_crc32) per piece; ``row`` tells repeated ids apart."""
    schema = "doc_id long, row long, piece int, start long, length long, ids_crc32 long"
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows = []
                texts = [t or "" for t in part.column(2).to_pylist()]
                for doc_id, row, found in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), token_ids(texts, vocabulary)):
                    data = found + end
                    for number, begin in enumerate(range(0, len(data), 4 * capacity)):
                        piece = data[begin : begin + 4 * capacity]
                        rows.append((doc_id, row, number, begin // 4, len(piece) // 4, zlib.crc32(piece)))
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), [pa.int64(), pa.int64(), pa.int32(), *[pa.int64()] * 3])]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "row", "piece", "start", "length", "ids_crc32"])

    return docs.select("doc_id", F.monotonically_increasing_id().alias("row"), "text").mapInArrow(releasing(run), schema)


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs, from two families of dual feasible functions.

    With threshold t, lengths over capacity - t count a whole bin, lengths under t nothing,
    others their share. With divisor k, each length counts floor((k + 1) x / capacity) / k,
    unless (k + 1) x is a multiple of the capacity, which counts x / capacity.
    """
    count = np.bincount(lengths, minlength=capacity + 1)[: capacity + 1]
    size = np.arange(capacity + 1)
    amount = np.cumsum(count * size)
    number = np.cumsum(count)
    total = int(amount[-1])
    best = -(-total // capacity)
    t = np.arange(1, capacity // 2 + 1)
    large = number[-1] - number[capacity - t]
    middle = amount[capacity - t] - amount[t - 1]
    if len(t):
        best = max(best, int((large + -(-middle // capacity)).max()))
    for k in range(1, 101):
        whole, rest = np.divmod((k + 1) * size, capacity)
        shares = np.where(rest == 0, size / capacity, whole / k)
        best = max(best, int(np.ceil(float((count * shares).sum()) - 1e-6)))
    return best


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Bin and offset of every length by best-fit decreasing, and the number of bins."""
    order = np.argsort(-lengths, kind="stable")
    bins = np.empty(len(lengths), np.int64)
    offsets = np.empty(len(lengths), np.int64)
    room: list[list[int]] = [[] for _ in range(capacity + 1)]
    filled = 0  # bit r is set where a bin with r tokens of room exists
    used = 0
    for i in order.tolist():
        n = int(lengths[i])
        fitting = filled >> n
        if fitting:
            r = n + ((fitting & -fitting).bit_length() - 1)
            b = room[r].pop()
            if not room[r]:
                filled &= ~(1 << r)
        else:
            r, b = capacity, used
            used += 1
        bins[i], offsets[i] = b, capacity - r
        left = r - n
        if left:
            room[left].append(b)
            filled |= 1 << left
    return bins, offsets, used


_PACKED = "doc_id long, row long, piece int, start long, length long, ids_crc32 long"


def pack(rows: DataFrame, capacity: int = CAPACITY, part_pieces: int | None = None, rounds: int = ROUNDS) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces, and the bins and bound of their partition."""
    part_pieces = part_pieces or PART_PIECES
    result_schema = f"{_PACKED}, part long, bin long, offset long, bins long, bound long, final boolean"

    def solve(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["length", "doc_id", "row", "piece"], kind="stable").reset_index(drop=True)
        lengths = part["length"].to_numpy()
        part["bin"], part["offset"], used = best_fit(lengths, capacity)
        bound = lower_bound(lengths, capacity)
        fill = np.bincount(part["bin"], weights=lengths, minlength=used)
        part["bins"], part["bound"] = used, bound
        part["final"] = True if used == bound else (fill == capacity)[part["bin"]]
        return part

    full = rows.where(F.col("length") == capacity)
    done = [
        full.select(
            "*",
            F.lit(-1).cast("long").alias("round"),
            F.monotonically_increasing_id().alias("part"),
            F.lit(0).cast("long").alias("bin"),
            F.lit(0).cast("long").alias("offset"),
        )
    ]
    open_rows = rows.where(F.col("length") < capacity)
    n = open_rows.count()
    for number in range(rounds):
        if not n:
            break
        parts = max(1, -(-n // part_pieces))
        last = number == rounds - 1 or parts == 1
        dealt = open_rows.withColumn(
            "part", F.pmod(F.xxhash64("doc_id", "row", "piece", F.lit(number)), F.lit(parts)).cast("long")
        )
        solved = materialize(dealt.groupBy("part").applyInPandas(solve, result_schema))
        final = solved if last else solved.where("final")
        done.append(final.withColumn("round", F.lit(number).cast("long")).drop("bins", "bound", "final"))
        if last:
            break
        open_rows = solved.where("not final").drop("part", "bin", "offset", "bins", "bound", "final")
        n = open_rows.count()
    packed = done[0]
    for more in done[1:]:
        packed = packed.unionByName(more)
    # Round, partition and bin in one number: 3 bits, 36 bits, 24 bits.
    sequence = (
        F.shiftleft(F.col("round") + 1, 60)
        .bitwiseOR(F.when(F.col("round") < 0, F.col("part")).otherwise(F.shiftleft(F.col("part"), 24)))
        .bitwiseOR(F.col("bin"))
    )
    return packed.withColumn("sequence_id", sequence.cast("long")).drop("round", "part", "bin", "row")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequence and offset of every piece of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    return pack(materialize(pieces(docs, public_tokenizers.path(VOCABULARY))))

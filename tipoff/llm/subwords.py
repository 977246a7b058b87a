"""SentencePiece BPE encoding by a score-ordered agenda of adjacent symbol pairs (op11).

A text is normalised as the model says (here: identity rules, a space mark in front, every space
turned into U+2581) and split into characters. Every adjacent pair whose concatenation is a
piece of the vocabulary goes onto an agenda ordered by that piece's score, ties to the leftmost
pair. The best pair is merged, stale pairs are skipped when they come up, and the merged symbol's
new pairs with its neighbours join the agenda, until no pair is left. Symbols that are not
pieces fall back to one byte piece per UTF-8 byte. Decoding joins the surfaces of the ids: the
space mark becomes a space (the first one of the first piece goes), byte runs are read as UTF-8
with one U+FFFD per byte that does not decode, control ids are empty, the unknown id is its
surface.

Pieces that hold the space mark after their first character consist of space marks only, so no
merge crosses from a character into a following space mark: a text falls into independent units
(a run of space marks and the characters up to the next one), and every distinct unit of a slice of
texts is encoded once. A vocabulary where this does not hold is encoded as one unit per text. The
agendas of units of at most ``SHORT`` characters are rows of one array: all of them merge their
best pair in step, ``STEP`` units at once. A longer unit is cut between adjacent characters that no piece
holds, since no merge can cross such a boundary, and parts that are still longer have a heap.

In Spark every batch of texts is encoded here and, in the same Arrow batch, by the sentencepiece
library; ``library_agrees`` says whether ids and decoded text are equal to the library's.

Edge cases: a null text is encoded as the empty text (no ids but the end id); rows with null or
repeated ids each give their own row; very long texts are encoded whole (the agenda costs
n log n in the length of a unit); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import codecs
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from operator import add

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "piece_bpe_32k.model"
SPACE = "▁"
SLICE_ROWS = 2048
SLICE_BYTES = 4 << 20
SHORT = 48  # characters of units that are merged in step: that work grows with the square of them
STEP = 4096  # units merged in step at once
# Pieces the agenda may build: normal, user-defined and unused ones (types 1, 4, 5 of the model).
MERGEABLE = (1, 4, 5)
_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")
_UNITS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


def _per_byte(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�", error.start + 1


codecs.register_error("tipoff_per_byte", _per_byte)


def _ranges(values: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Ranges of values, one after the other: each from its first place on."""
    ends = np.cumsum(sizes)
    return values[np.repeat(first - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)]


class PieceModel:
    """The pieces, scores and normaliser settings of one sentencepiece BPE model file."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        if proto.trainer_spec.model_type != pb.TrainerSpec.BPE:
            raise ValueError("only merge-type (BPE) models are encoded here")
        spec = proto.normalizer_spec
        if spec.name != "identity" or spec.remove_extra_whitespaces or spec.precompiled_charsmap:
            raise ValueError(f"normaliser {spec.name!r} is not supported: only identity rules are")
        if proto.trainer_spec.treat_whitespace_as_suffix or any(p.type == 5 for p in proto.pieces):
            raise ValueError("space marks as suffix and unused pieces are not supported")
        if any(p.type == 4 for p in proto.pieces):
            raise ValueError("user-defined pieces are not supported")
        self.dummy_prefix = spec.add_dummy_prefix
        self.escape = spec.escape_whitespaces
        self.byte_fallback = proto.trainer_spec.byte_fallback
        self.unk_id = proto.trainer_spec.unk_id
        self.unk_surface = proto.trainer_spec.unk_surface
        self.scores: dict[str, float] = {}
        self.ids: dict[str, int] = {}
        self.byte_ids = [self.unk_id] * 256
        self.surfaces: list[str | int] = []
        for i, p in enumerate(proto.pieces):
            byte = _BYTE_PIECE.fullmatch(p.piece) if p.type == 6 else None
            if p.type in MERGEABLE:
                self.scores[p.piece] = p.score
                self.ids[p.piece] = i
                self.surfaces.append(p.piece.replace(SPACE, " "))
            elif byte:
                self.byte_ids[int(byte.group(1), 16)] = i
                self.surfaces.append(int(byte.group(1), 16))
            elif p.type == 2:
                self.surfaces.append(self.unk_surface)
            else:
                self.surfaces.append("")
        self.lead = [isinstance(s, str) and s.startswith(" ") and p.type in MERGEABLE for s, p in zip(self.surfaces, proto.pieces)]
        self.control = [p.type == 3 for p in proto.pieces]
        # Bytes of ASCII characters stand for themselves whatever is beside them; the others do not.
        self.plain = [chr(s) if isinstance(s, int) else s for s in self.surfaces]
        self.partial = frozenset(i for i, s in enumerate(self.surfaces) if isinstance(s, int) and s >= 0x80)
        # No piece glues a character to a following space mark: units are independent.
        self.units = all(set(p[p.index(SPACE) :]) == {SPACE} for p in self.scores if SPACE in p[1:])
        # With a mark in front of the text every unit begins with one; units are listed without it.
        self.mark = SPACE if self.units and self.escape and self.dummy_prefix else ""
        # Symbols are the ids of mergeable pieces, then numbers of other characters that pieces hold, then OTHER.
        symbols = dict(self.ids)
        for character in sorted({c for p in self.scores for c in p} - symbols.keys()):
            symbols[character] = len(proto.pieces) + len(symbols) - len(self.ids)
        self.other = len(proto.pieces) + len(symbols) - len(self.ids)
        self.symbol = np.full(0x110000, self.other)
        for symbol, number in symbols.items():
            if len(symbol) == 1:
                self.symbol[ord(symbol)] = number
        # Rank of every score, best first; equal scores share a rank.
        self.joins = {pair for p in self.scores for pair in map(add, p, p[1:])}
        order = {score: i for i, score in enumerate(sorted(set(self.scores.values()), reverse=True))}
        self.none = len(order)
        pairs = [
            (symbols[p[:i]] * (self.other + 1) + symbols[p[i:]], order[score], self.ids[p])
            for p, score in self.scores.items() for i in range(1, len(p)) if p[:i] in symbols and p[i:] in symbols
        ]
        keys, ranks, merged = np.array(pairs, np.int64).reshape(-1, 3).T
        # Pairs of symbols that make a piece, with its rank and id; number -1 is that of no pair.
        self.pairs, self.ranks, self.merged = pd.Index(keys), np.append(ranks, self.none).astype(np.int32), np.append(merged, -1)

    def merge(self, unit: str) -> list[int]:
        """Ids of one unit, whatever its length."""
        return self.known(self.merge_long(unit))

    def merge_short(self, characters: np.ndarray) -> np.ndarray:
        """Symbols of short units, a row of ``characters`` each (-1 behind its end); -1 where one was merged away.

        The agenda of a unit is a row of ranks in the order of the text. All units merge their best, leftmost
        pair in step, until no pair of any of them is left.
        """
        n, width = characters.shape
        none = n * width  # place of no symbol
        symbols = np.append(np.where(characters < 0, self.other, self.symbol[characters]).reshape(-1), self.other)
        after, before = np.arange(1, none + 2), np.arange(-1, none)
        after[width - 1 : none : width] = before[:none:width] = after[none] = none
        at = symbols[:-1] * (self.other + 1) + symbols[1:]
        at[width - 1 :: width] = -1
        number = np.append(self.pairs.get_indexer(at), -1)
        ranks = self.ranks[number]
        agenda, rows = ranks[:none].reshape(n, width), np.arange(n)
        while len(rows):
            left = rows * width + agenda[rows].argmin(axis=1)
            found = ranks[left] < self.none
            rows, left = rows[found], left[found]
            merged, right = self.merged[number[left]], after[left]
            symbols[left], symbols[right], ranks[right] = merged, -1, self.none
            beyond, first = after[right], before[left]
            after[left], before[beyond] = beyond, left
            pair = np.concatenate([symbols[first] * (self.other + 1) + merged, merged * (self.other + 1) + symbols[beyond]])
            places, new = np.concatenate([first, left]), self.pairs.get_indexer(pair)
            number[places], ranks[places] = new, self.ranks[new]
        return np.where(characters < 0, -1, symbols[:none].reshape(n, width))

    def ids_of(self, characters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of short units, one after the other, and their number per unit."""
        symbols = self.merge_short(characters)
        row, column = np.nonzero(symbols >= 0)
        ids, size = symbols[row, column].astype(np.int32), np.ones(len(row), np.int64)
        spelt = np.flatnonzero(ids >= len(self.surfaces))  # characters that are no piece
        which, of = np.unique(characters[row[spelt], column[spelt]], return_inverse=True)
        each = [self.known([chr(c)]) for c in which.tolist()]
        number = np.array([len(x) for x in each], np.int64)
        size[spelt] = number[of]
        first = np.cumsum(size) - size
        ids = np.repeat(ids, size)
        places = _ranges(np.arange(len(ids)), first[spelt], number[of])
        ids[places] = _ranges(np.fromiter(chain.from_iterable(each), np.int32), (np.cumsum(number) - number)[of], number[of])
        return ids, np.bincount(row, weights=size, minlength=len(characters)).astype(np.int64)

    def merge_long(self, unit: str) -> list[str]:
        """Pieces of a unit of any length: its agenda is a heap, pairs that have changed are skipped."""
        pieces = list(unit)
        n = len(pieces)
        after = list(range(1, n + 1))
        after[-1] = -1
        before = list(range(-1, n - 1))
        scores, agenda = self.scores, []

        def offer(left: int, right: int) -> None:
            score = scores.get(pieces[left] + pieces[right])
            if score is not None:
                agenda.append((-score, left, right, len(pieces[left]) + len(pieces[right])))

        for i in range(n - 1):
            offer(i, i + 1)
        heapq.heapify(agenda)
        while agenda:
            _, left, right, size = heapq.heappop(agenda)
            a, b = pieces[left], pieces[right]
            if not a or not b or len(a) + len(b) != size:
                continue  # one side has changed since the pair was offered
            pieces[left], pieces[right] = a + b, ""
            after[left] = after[right]
            if after[right] >= 0:
                before[after[right]] = left
            for pair in ((before[left], left), (left, after[left])):
                if pair[0] >= 0 and pair[1] >= 0:
                    score = scores.get(pieces[pair[0]] + pieces[pair[1]])
                    if score is not None:
                        heapq.heappush(agenda, (-score, *pair, len(pieces[pair[0]]) + len(pieces[pair[1]])))
        return [piece for piece in pieces if piece]

    def known(self, pieces: list[str]) -> list[int]:
        """Ids of pieces; one that is not in the vocabulary falls back to its bytes."""
        found = list(map(self.ids.get, pieces))
        if None not in found:
            return found
        out = []
        for piece, known in zip(pieces, found):
            if known is not None:
                out.append(known)
            elif self.byte_fallback:
                out.extend(self.byte_ids[b] for b in piece.encode("utf-8"))
            else:
                out.append(self.unk_id)
        return out

    def encode(self, text: str | None) -> list[int]:
        """Ids of a text (null: empty), without begin or end ids."""
        return self.encode_all([text or ""])[0].tolist()

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and the place of every text's first id (and of the end)."""
        split = [self.split(text) for text in texts]
        units = pa.array(chain.from_iterable(split), pa.string()).dictionary_encode()
        ids, first, sizes = self.encode_units(units.dictionary, self.mark)
        of = units.indices.to_numpy()
        sizes = sizes[of]
        ends = np.append(0, np.cumsum(sizes))
        return _ranges(ids, first[of], sizes), ends[np.append(0, np.cumsum([len(x) for x in split], dtype=np.int64))]

    def encode_units(self, units: pa.StringArray, mark: str, cut: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of units with ``mark`` in front, and the place of each unit's first id and their number.

        Long units are cut between adjacent characters that no piece holds, since no merge crosses such a
        boundary; what is long still is merged alone.
        """
        length = pc.utf8_length(units).to_numpy(zero_copy_only=False).astype(np.int64)
        begin = np.cumsum(length) - length
        order = np.argsort(length, kind="stable")
        short = int(np.searchsorted(length[order], SHORT, side="right"))
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(units)], pa.int32()), units), "")[0].as_py()
        text = np.frombuffer(joined.encode("utf-32-le"), "<u4").astype(np.int32)
        text = np.append(text, np.int32(-1))
        ids, each = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for at in range(0, short, STEP):
            pick = order[at : min(short, at + STEP)]
            column = np.arange(length[pick[-1]])
            characters = np.full((len(pick), len(mark) + len(column)), ord(SPACE), np.int32)
            characters[:, len(mark) :] = text[np.where(column < length[pick, None], begin[pick, None] + column, -1)]
            found, sizes = self.ids_of(characters)
            ids.append(found)
            each.append(sizes)
        long = [mark + units[i].as_py() for i in order[short:].tolist()]
        if long and cut:
            parts = [list(self.parts(unit)) for unit in long]
            flat = pa.array(chain.from_iterable(parts), pa.string()).dictionary_encode()
            found, first, sizes = self.encode_units(flat.dictionary, "", False)
            first, sizes = first[flat.indices.to_numpy()], sizes[flat.indices.to_numpy()]
            ids.append(_ranges(found, first, sizes))
            each.append(np.add.reduceat(sizes, np.cumsum([0, *map(len, parts[:-1])])))
        elif long:
            found = [self.merge(unit) for unit in long]
            ids.append(np.fromiter(chain.from_iterable(found), np.int32))
            each.append(np.array([len(x) for x in found]))
        sizes, first = np.empty_like(order), np.empty_like(order)
        each = np.concatenate(each)
        sizes[order], first[order] = each, np.cumsum(each) - each
        return np.concatenate(ids), first, sizes

    def parts(self, unit: str) -> Iterator[str]:
        """A unit cut between adjacent characters that no piece holds."""
        joins, start = self.joins, 0
        for i in range(1, len(unit)):
            if unit[i - 1 : i + 1] not in joins:
                yield unit[start:i]
                start = i
        yield unit[start:]

    def split(self, text: str) -> list[str]:
        """Units of a text, each without ``mark`` in front of it."""
        if not text:
            return []
        if self.mark and "  " not in text and SPACE not in text and text[0] != " " and text[-1] != " ":
            return text.split(" ")
        if self.escape:
            text = text.replace(" ", SPACE)
        if self.dummy_prefix:
            text = SPACE + text
        return [unit[len(self.mark) :] for unit in _UNITS.findall(text)] if self.units else [text]

    def decode(self, ids: list[int]) -> str:
        """Text of ids as the library's decode gives it."""
        if not ids or self.control[ids[0]] or not self.partial.isdisjoint(ids):
            return self.decode_bytes(ids)
        text = "".join(map(self.plain.__getitem__, ids))
        return text[1:] if self.dummy_prefix and self.lead[ids[0]] else text

    def decode_bytes(self, ids: list[int]) -> str:
        """Text of ids that may hold bytes of longer characters."""
        out, run, first = [], bytearray(), True
        for i in ids:
            surface = self.surfaces[i]
            if isinstance(surface, int):
                run.append(surface)
                first = False
                continue
            if run:
                out.append(run.decode("utf-8", "tipoff_per_byte"))
                run = bytearray()
            if self.control[i]:
                continue
            if first and self.lead[i] and self.dummy_prefix:
                surface = surface[1:]
            first = False
            out.append(surface)
        if run:
            out.append(run.decode("utf-8", "tipoff_per_byte"))
        return "".join(out)


@lru_cache(maxsize=2)
def load(path: str) -> PieceModel:
    return PieceModel(path)


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in slices of at most ``SLICE_ROWS`` rows and ``SLICE_BYTES`` bytes of text, one row at least."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        before = sizes[at - 1] if at else 0
        end = max(at + 1, min(at + SLICE_ROWS, int(np.searchsorted(sizes, before + SLICE_BYTES, side="right"))))
        yield batch.slice(at, end - at)
        at = end


ENCODED = "doc_id long, ids array<int>, text string, library_agrees boolean"


def encode(docs: DataFrame, model_path: str, end: bool = True) -> DataFrame:
    """Ids (ending in the end id when ``end``) and decoded text of every row of ``docs``.

    Runs where the rows are, without a shuffle: each Arrow batch is encoded slice by slice by the
    agenda and again by the library, whose results are compared.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from sentencepiece import SentencePieceProcessor

        model = load(model_path)
        library = SentencePieceProcessor(model_file=model_path)
        tail = [library.eos_id()] if end else []
        for batch in batches:
            for part in slices(batch):
                texts = [t or "" for t in part.column("text").to_pylist()]
                ids, ends = model.encode_all(texts)
                if end:
                    ids, ends = np.insert(ids, ends[1:], library.eos_id()), ends + np.arange(len(ends))
                flat, places = ids.tolist(), ends.tolist()
                mine = [flat[a:b] for a, b in zip(places, places[1:])]
                decoded = [model.decode(x) for x in mine]
                theirs = library.encode(texts, num_threads=1)
                agrees = [own == their + tail and text == library.decode(their + tail) for own, their, text in zip(mine, theirs, decoded)]
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), lists, pa.array(decoded, pa.string()), pa.array(agrees, pa.bool_())],
                    names=["doc_id", "ids", "text", "library_agrees"],
                )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, ENCODED)


def digests(encoded: DataFrame) -> DataFrame:
    """Id count and SHA-256 digests of the ids (decimal, one space between) and the decoded text."""
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("text"), 256).alias("decoded_sha256"),
        "library_agrees",
    )


def op11_sentencepiece(spark, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every whole text of ``documents``, as digests."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    return digests(encode(docs, public_tokenizers.path(VOCABULARY)))

"""Best-fit packing of tokenised documents by hierarchical residual merging.

Tokens: every worker keeps the ids of the words it met last and joins a
document's ids from them (white space always ends a token of this
vocabulary, so ids of a text are the ids of its words in a row). Documents
longer than a sequence are cut into full pieces and a rest.

Packing: pieces are dealt over nodes, each of which packs its share best-fit
in decreasing size. Nearly full bins are final. The underfull ones go up a
tree as items of their own and are packed again, ``fan_in`` nodes at a time,
up to the root. A parent that gets more than a leaf's rows is split into
several nodes, so no task grows with the corpus. Bins that a round with no
fewer nodes hardly reduces are final as they are; no piece is lost.

Cases: a null or empty text is one piece of the end id alone; repeated rows
are packed one by one; an empty table gives no rows.
"""

from __future__ import annotations

import math
import zlib
from array import array
from collections.abc import Callable, Iterator
from string import punctuation

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.text import remembered
from strata.session import stage_table

CAPACITY = 4096
END_ID = 1
#: Words that a worker process keeps encoded, those met last.
MEMO_WORDS = 120_000
END_BYTES = END_ID.to_bytes(4, "little")


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordEncoder(dict):
    """Raw word -> little-endian 32-bit ids, kept for the words that this process met last.

    Words of plain printable characters up to U+024F (where lower-casing and
    normal form need no context; printable ones, so no odd blank) are cut by the vocabulary's own pattern and
    each piece goes through the model once; any other word goes through the
    whole tokenizer.
    """

    #: The cut of this vocabulary, as its file states it.
    PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.pieces: dict[str, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.as_bytes = {
            c: self.tokenizer.pre_tokenizer.pre_tokenize_str(chr(c))[0][0]
            for c in range(33, 0x250)
            if chr(c).isprintable()
        }

    def piece_ids(self, piece: str) -> bytes:
        ids = array("I", [t.id for t in self.model.tokenize(piece.translate(self.as_bytes))]).tobytes()
        self.pieces[piece] = ids
        return ids

    def __missing__(self, word: bytes) -> bytes:
        ids = self.older.get(word)
        if ids is not None:
            self[word] = ids
            return ids
        text = word.decode("utf-8")
        lowered = text.lower()
        if max(text + lowered) >= "\u0250" or not text.isprintable() or "<|" in text:
            ids = array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        else:
            letters = lowered.rstrip(punctuation)
            if letters.isalpha():  # the common case: letters, then punctuation or nothing
                parts = [letters, lowered[len(letters) :]] if len(letters) < len(lowered) else [letters]
            else:
                parts = self.PIECES.findall(lowered)
            ids = b"".join([self.pieces.get(p) or self.piece_ids(p) for p in parts])
        self[word] = ids
        return ids

    def encode(self, text: bytes | None) -> bytes:
        """Ids of a whole text, the end id last."""
        return b"".join(map(self.__getitem__, (text or b"").split())) + END_BYTES

    def trim(self, most: int = MEMO_WORDS) -> None:
        """Forgets the words not met lately once there are more than half of what may be kept."""
        if len(self) > most // 2:
            self.older = dict(self)
            self.clear()
            self.pieces.clear()


def encoder(path: str) -> WordEncoder:
    """This process's encoder: a worker that runs several tasks keeps its words."""
    return remembered(("packing", path), lambda: WordEncoder(path))


def tokenize_pieces(
    docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, keep_ids: bool = False
) -> DataFrame:
    """One row per piece of a document: its place, length, checksum and, on demand, its ids."""
    docs = docs.select("doc_id", "text")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    path = vocabulary or vocabulary_path()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        step = 4 * capacity
        for batch in batches:
            for at in range(0, batch.num_rows, 2_000):
                part = batch.slice(at, 2_000)
                rows, piece, start, length, crc, ids = [], [], [], [], [], []
                for k, text in enumerate(part.column(1).cast(pa.binary()).to_pylist()):
                    data = coder.encode(text)
                    for p, lo in enumerate(range(0, len(data), step)):
                        cut = data[lo : lo + step]
                        rows.append(k)
                        piece.append(p)
                        start.append(lo // 4)
                        length.append(len(cut) // 4)
                        crc.append(zlib.crc32(cut))
                        if keep_ids:
                            ids.append(np.frombuffer(cut, dtype="<u4").astype("int32"))
                coder.trim()
                out = [
                    part.column(0).take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
                ]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if keep_ids:
                    out.append(pa.array(ids, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(out, names=names)

    schema = f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long"
    return docs.mapInArrow(pieces, schema + (", ids array<int>" if keep_ids else ""))


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Best-fit decreasing: the bin and the offset of every item (sizes of 1 to capacity).

    Open bins are kept by free space; one integer has a bit for every free
    space at hand, so the tightest fit is its lowest bit from the size on.
    """
    bins = np.empty(len(sizes), dtype=np.int64)
    offsets = np.empty(len(sizes), dtype=np.int64)
    by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_mask, n_bins = 0, 0
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        fitting = open_mask >> size
        if fitting:
            free = size + (fitting & -fitting).bit_length() - 1
            b = by_free[free].pop()
            if not by_free[free]:
                open_mask &= ~(1 << free)
        else:
            free, b = capacity, n_bins
            n_bins += 1
        bins[i], offsets[i] = b, capacity - free
        left = free - size
        if left:
            by_free[left].append(b)
            open_mask |= 1 << left
    return bins, offsets


def _node_packer(level: int, capacity: int, full: int) -> Callable:
    """Packs what one node of the tree got; ``sequence_id`` is the bin as packed so far."""

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        node = int(pdf["node"].iloc[0])
        _, first, item = np.unique(pdf["sequence_id"].to_numpy(), return_index=True, return_inverse=True)
        fill = np.bincount(item, weights=pdf["length"].to_numpy()).astype(np.int64)
        bins, offsets = best_fit(fill, capacity)
        filled = np.bincount(bins, weights=fill).astype(np.int64)
        row_bin = bins[item]
        pdf["offset"] = pdf["offset"].to_numpy() + offsets[item]
        pdf["sequence_id"] = (np.int64(level) << 54) + (np.int64(node) << 24) + row_bin
        pdf["final"] = (filled >= full)[row_bin]
        return pdf

    return pack


def pack_pieces(
    pieces: DataFrame,
    capacity: int = CAPACITY,
    node_pieces: int = 50_000,
    fan_in: int = 8,
    full_share: float = 0.995,
    least_gain: float = 0.05,
) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces of at most ``capacity`` tokens.

    ``node_pieces`` pieces on average go to a leaf of the tree, whatever
    their ids are: rows are dealt by their number, so no key can be hot. All
    bins that are not nearly full go up; a parent that gets more rows than a
    leaf is several nodes, to which its bins are dealt by a hash. The rounds
    end with one node, or when nodes get no fewer and a round leaves more than
    1 - ``least_gain`` of the bins it got: such bins don't fit each other.
    """
    columns = pieces.columns
    work, _ = stage_table(pieces.withColumn("row_no", F.monotonically_increasing_id()), "packing_pieces")
    n_nodes = max(1, math.ceil(work.count() / node_pieces))
    rows = work.select(
        "row_no", "length", F.pmod(F.xxhash64("row_no"), F.lit(n_nodes)).alias("node"),
        F.col("row_no").alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
    )
    schema = "row_no long, length long, node long, sequence_id long, offset long, final boolean"
    full = math.ceil(full_share * capacity)
    placed: DataFrame | None = None
    level, bins = 1, work.count()
    while True:
        packer = _node_packer(level, capacity, full)
        packed, _ = stage_table(rows.groupBy("node").applyInPandas(packer, schema), f"packing_level{level}")
        left = packed.filter("not final")
        n = left.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("sequence_id").alias("bins")).first()
        parents = math.ceil(n_nodes / fan_in)
        split = max(1, math.ceil(n["rows"] / (parents * node_pieces)))
        last = n_nodes == 1 or not n["rows"]
        last = last or (parents * split >= n_nodes and n["bins"] > (1.0 - least_gain) * bins)
        done = (packed if last else packed.filter("final")).select("row_no", "sequence_id", "offset")
        placed = done if placed is None else placed.unionByName(done)
        if last:
            break
        n_nodes, bins = parents * split, n["bins"]
        part = F.pmod(F.xxhash64("sequence_id"), F.lit(split))
        rows = left.select(
            "row_no", "length", (F.floor(F.col("node") / fan_in) * split + part).alias("node"), "sequence_id", "offset"
        )
        level += 1
    return work.join(placed, "row_no").select(*columns, "sequence_id", "offset")


def sequences(packed: DataFrame) -> DataFrame:
    """The packed token sequences themselves (pieces made with ``keep_ids``)."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(
        F.flatten(F.transform(ordered, lambda p: p["ids"])).alias("ids"), F.sum("length").alias("length")
    )

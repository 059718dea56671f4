"""Packing by concatenating and cutting: prefix sums over partitions give global offsets, fixed windows cut the stream."""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import byte_letters
from .common import write_table

WINDOW = 4096
END_ID = 2
#: Encoded pieces of text that a worker remembers, and the letters up to which it does; when there are more it starts anew.
REMEMBERED, SHORT = 500_000, 64
#: Letters and marks that make up most parts.
PLAIN = re.compile("([a-zß-öø-ÿ]+)([.,;:!?*#$%&|]*)")
#: Marks that normalising may join with the letter before, which tells capitals from small letters; it comes before lower-casing.
JOINING = re.compile("[\u0300-\u036f]")
TOKENS = "part int, before long, doc_id long, n_tokens long, ids binary"
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"


class TextEncoder(dict):
    """Ids of a text as little-endian 32-bit bytes, by the tokenizers library.

    The vocabulary's normaliser and splitter never reach across blanks, so a text's ids are those of its parts between blanks; each
    distinct part is encoded once and remembered. A part of Latin-1 letters and some marks after them is a run of either kind, which
    normalising leaves as it is but for case: the model gets these runs directly, in the letters that stand for their bytes.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        letters = dict(enumerate(byte_letters()))
        self.runs = lambda run: self.tokenizer.model.tokenize(run.encode().decode("latin-1").translate(letters))

    def __missing__(self, part: str) -> bytes:
        if plain := PLAIN.fullmatch(part.lower()):
            ids = [x.id for run in plain.groups() if run for x in self.runs(run)]
        else:
            ids = self.tokenizer.encode(part, add_special_tokens=False).ids
        found = array("I", ids).tobytes()
        if len(part) <= SHORT:
            if len(self) >= REMEMBERED:
                self.clear()
            self[part] = found
        return found

    def __call__(self, text: str | None) -> bytes:
        if not text:
            return b""
        if "<|" not in text and (text.isascii() or not JOINING.search(text)):  # special tokens are told by case, too
            text = text.encode().lower().decode()
        return b"".join(map(self.__getitem__, text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")))


def tokenize(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pass one: each document's ids (with end_id at the end), its partition and the ids before it there."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, before = TextEncoder(tokenizer_path), TaskContext.get().partitionId(), 0
        end = end_id.to_bytes(4, "little")
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                some = batch.slice(start, 500)
                ids = [encode(x) + end for x in some["text"].to_pylist()]
                counts, sums = [len(x) // 4 for x in ids], []
                for n in counts:
                    sums.append(before)
                    before += n
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(ids), pa.int32()), pa.array(sums, pa.int64()), some["doc_id"], pa.array(counts, pa.int64()), pa.array(ids, pa.binary())],
                    ["part", "before", "doc_id", "n_tokens", "ids"],
                )

    return docs.selectExpr(f"cast(`{id_col}` as bigint) as doc_id", f"`{text_col}` as text").mapInArrow(rows, TOKENS)


def pack(docs: DataFrame, tokenizer_path: str | None = None, window: int = WINDOW, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Concatenates all documents' ids and cuts the stream into sequences of `window` ids; only the last one is shorter.

    Returns a row for each piece of a document in a sequence, with its ids: a document that crosses a boundary has a record on either
    side. A null text counts as empty and consists of end_id alone, so no document is lost; null ids stay, repeated rows are documents
    of their own, other columns go, and an empty table has no pieces. A text of any length is encoded whole, by one task, and cut into as
    many pieces as it takes.

    Pass one writes ids and running counts to the shared folder. The driver then gets one total for each partition, and pass two cuts
    each document by its global offset. Nothing is shuffled, and lost executors can't change offsets that are on file.
    """
    tokens = write_table(tokenize(docs, tokenizer_path or public_tokenizers.path("word_bpe_49k.json"), end_id, id_col, text_col), "tokens")
    totals = tokens.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect()
    base, at = {}, 0
    for r in totals:
        base[r["part"]] = at
        at += r["n"]
    offsets = docs.sparkSession.sparkContext.broadcast(base)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            size = 0
            for part, before, doc_id, n, ids in zip(*(batch[c].to_pylist() for c in ("part", "before", "doc_id", "n_tokens", "ids")), strict=True):
                first, start = offsets.value[part] + before, 0
                while start < n:
                    sequence, offset = divmod(first + start, window)
                    length = min(n - start, window - offset)
                    piece = ids[4 * start : 4 * (start + length)]
                    out.append((doc_id, start, length, zlib.crc32(piece), n, sequence, offset, piece))
                    start, size = start + length, size + len(piece)
                if size > 16_000_000:
                    yield _pieces(out)
                    out, size = [], 0
            yield _pieces(out)

    return tokens.mapInArrow(rows, PIECES)


def _pieces(rows: list[tuple]) -> pa.RecordBatch:
    names = [x.split()[0] for x in PIECES.split(", ")]
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.binary() if n == "ids" else pa.int64()) for n, c in zip(names, columns, strict=True)], names)


def sequences(pieces: DataFrame) -> DataFrame:
    """The packed sequences themselves: sequence_id, n_tokens and ids (pieces joined by offset); a sequence has at most a window's ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return pieces.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), parts.alias("p")).select(
        "sequence_id", "n_tokens", F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids")
    )

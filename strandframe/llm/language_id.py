"""Language ID by compression: a zstandard raw-content dictionary for each language; the smallest encoding wins."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import named, shielded, unshielded

#: Labelled texts in a language's dictionary, the longest that is taken (characters), and the dictionary's bytes.
SAMPLE_TEXTS = 400
SAMPLE_CHARS = 32_768
DICTIONARY_BYTES = 262_144
#: Characters that are fetched for a dictionary, as a multiple of its bytes: marks and digits of texts don't go in.
FILL = 1.5
#: Below this margin a text is encoded again with each dictionary in so many parts, whose sizes are added: ties get rarer.
NARROW, PARTS = 0.03, 8
#: Longest piece of a text that is encoded in one go, in bytes: a dictionary helps with the first bytes only, so each piece gets it afresh.
BLOCK_BYTES = 16_384
#: A text is rejected if the best encoding is smaller than the second best by less than this share of it.
MIN_MARGIN = 0.002
UNKNOWN = "und"
_others = re.compile(r"[\W\d_]+")
SCHEMA = "doc_id long, lang_pred string, score double, rejected boolean"


def words_of(text: str) -> bytes:
    """The text's letters in lower case, with one blank for whatever stands between."""
    return f" {_others.sub(' ', text.lower()).strip()} ".encode()


def blocks_of(data: bytes) -> list[bytes]:
    """The data in pieces of about the same size, at most BLOCK_BYTES."""
    size = -(-len(data) // -(-len(data) // BLOCK_BYTES))
    return [data[k : k + size] for k in range(0, len(data), size)]


def train_dictionaries(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", max_languages: int | None = None) -> dict[str, bytes]:
    """A dictionary for each language out of labelled rows: a sample of at most SAMPLE_TEXTS texts (the first SAMPLE_CHARS characters of
    each), chosen by the text's hash, and of these no more than fill DICTIONARY_BYTES: the driver gets a bounded number of characters.
    All languages have one (with `max_languages`, only so many, the most frequent): DICTIONARY_BYTES each at most, which every task gets.
    Rows with null or empty text or null language are left out, repeated texts count once; without usable rows there are no languages."""
    text = F.substring(named(text_col), 1, SAMPLE_CHARS)
    rows = labelled.where(named(lang_col).isNotNull() & (F.length(named(text_col)) > 0)).select(named(lang_col).alias("lang"), text.alias("text"))
    keyed = rows.select("lang", F.xxhash64("text").alias("h"), F.length("text").alias("n"))
    counts = keyed.groupBy("lang").count().orderBy(F.desc("count"), "lang")
    most = {r["lang"]: r["count"] for r in (counts if max_languages is None else counts.limit(max_languages)).collect()}
    langs = sorted(most)
    if not langs:
        return {}
    # Hashes spread evenly, so a bound on them keeps about twice the texts wanted; the smallest hashes of these are taken.
    bounds = {x: min(2**63 - 1, -(2**63) + int(2**64 * min(1.0, 2 * SAMPLE_TEXTS / n))) for x, n in most.items()}
    bound = F.create_map(*(F.lit(x) for pair in bounds.items() for x in pair))[F.col("lang")]
    found: dict[str, dict[int, int]] = {x: {} for x in langs}
    for r in keyed.where(F.col("h") <= bound).distinct().collect():
        found[r["lang"]][r["h"]] = r["n"]
    chosen: dict[str, list[int]] = {}
    for lang, sizes in found.items():
        some, filled = sorted(sizes)[:SAMPLE_TEXTS], 0
        while some and filled < FILL * DICTIONARY_BYTES:
            chosen.setdefault(lang, []).append(h := some.pop())
            filled += sizes[h]
    keys = sorted({h for some in chosen.values() for h in some})
    texts = rows.where(F.xxhash64("text").isin(keys)).groupBy("lang", F.xxhash64("text").alias("h")).agg(F.min("text").alias("text")).collect() if keys else []
    out: dict[str, bytes] = {}
    for lang in langs:
        mine = sorted((r["h"], r["text"]) for r in texts if r["lang"] == lang and r["h"] in set(chosen.get(lang, [])))
        joined = b"".join(words_of(text) for _, text in mine)
        if joined.strip():
            out[lang] = joined[-DICTIONARY_BYTES:]
    return out


def _encoder(content: bytes, level: int, strategy: int) -> zstandard.ZstdCompressor:
    made = zstandard.ZstdCompressionParameters.from_level(
        level, source_size=4096, dict_size=len(content), strategy=strategy, min_match=4, write_content_size=False, write_checksum=False, write_dict_id=False
    )
    dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    dictionary.precompute_compress(compression_params=made)
    return zstandard.ZstdCompressor(compression_params=made, dict_data=dictionary)


class Classifier:
    """Encoders primed with the dictionaries. Ties go to the language with the larger dictionary, then to the first by name."""

    def __init__(self, dictionaries: dict[str, bytes]):
        self.langs = sorted(dictionaries, key=lambda x: (-len(dictionaries[x]), x))
        self.encoders = [_encoder(dictionaries[x], 5, zstandard.STRATEGY_GREEDY) for x in self.langs]
        size = {x: -(-len(dictionaries[x]) // PARTS) for x in self.langs}
        self.parts = [[_encoder(dictionaries[x][k : k + size[x]], 7, zstandard.STRATEGY_LAZY2) for k in range(0, len(dictionaries[x]), size[x])] for x in self.langs]

    def _best(self, sizes: list[float]) -> tuple[int, float]:
        best = min(range(len(sizes)), key=sizes.__getitem__)
        others = sizes[:best] + sizes[best + 1 :]
        return best, 1 - sizes[best] / min(others) if others else 1.0

    def __call__(self, text: str | None) -> tuple[str, float, bool]:
        """Language, margin (share by which the second best is larger, 0 to 1), whether the margin is too narrow."""
        if not self.langs:
            return UNKNOWN, 0.0, False
        if not text or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0, True
        blocks = blocks_of(words_of(text))
        best, margin = self._best([sum(len(x.compress(b)) for b in blocks) for x in self.encoders])
        if margin < NARROW:
            best, margin = self._best([sum(len(x.compress(b)) for x in parts for b in blocks) / len(parts) for parts in self.parts])
        return self.langs[best], margin, margin < MIN_MARGIN


def identify(docs: DataFrame, dictionaries: dict[str, bytes], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Predicted language, score and rejection of each whole text.

    lang_pred is a language of the dictionaries, or und (and rejected) if the text is null or has no letter (Unicode category L). score is
    the margin by which the best encoding beats the second best, both added up over pieces of at most BLOCK_BYTES, so that it doesn't
    shrink as texts get longer; where it is below NARROW, it is told by encodings with parts of the dictionaries, averaged. rejected is
    true where it is narrower than MIN_MARGIN. Without dictionaries all are und, score 0, and none is rejected, as nothing was compared.
    Equal texts get equal results; repeated rows and null ids stay, other columns go, an empty table stays so. The dictionaries (at most
    one for each language, of DICTIONARY_BYTES at most) are broadcast; one pass, no shuffle.
    """
    model = docs.sparkSession.sparkContext.broadcast(dictionaries)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classify = Classifier(model.value)
        for batch in batches:
            found = [classify(x.as_py()) for x in batch["text"]]
            columns = list(zip(*found, strict=True)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(columns[0], pa.string()), pa.array(columns[1], pa.float64()), pa.array(columns[2], pa.bool_())], ["doc_id", "lang_pred", "score", "rejected"])

    return docs.selectExpr(f"cast(`{id_col}` as bigint) as doc_id", f"`{text_col}` as text").mapInArrow(rows, SCHEMA)


def keep_identified(docs: DataFrame, dictionaries: dict[str, bytes], text_col: str = "text") -> DataFrame:
    """The rows of docs that identify() doesn't reject, with all their columns, whatever their names. Null texts and texts without a letter
    go (unless there are no dictionaries: then all rows stay); null ids and repeated rows stay; an empty table stays so."""
    model = docs.sparkSession.sparkContext.broadcast(dictionaries)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classify = Classifier(model.value)
        for batch in batches:
            yield batch.filter(pa.array([not classify(x.as_py())[2] for x in batch[text_col]], pa.bool_()))

    plain, names = shielded(docs, text_col)
    return unshielded(plain.mapInArrow(rows, plain.schema), names, docs.columns)


def is_training(doc_id: Column) -> Column:
    """The rows that op4 may learn from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 != 2

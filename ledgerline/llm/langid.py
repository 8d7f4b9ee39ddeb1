"""Language ID by compression: a text has the language whose dictionary compresses it best.

For each language of the labelled documents, a raw-content dictionary of ``DICTIONARY_BYTES`` is made of a bounded sample:
about ``SAMPLE_DOCS`` different texts a language, drawn by a hash of the text, copies counting once, and of each as many
characters as fill the dictionary together, in ``PIECES`` pieces spread from its beginning to its end. Documents that are
held out are never used. The driver holds one dictionary a language and nothing else of the texts. A whole text, in lower case, is cut into chunks of ``CHUNK_BYTES``, every
chunk is compressed with each dictionary, with matches from four bytes on, and the sizes are added up: the smallest
language wins, of equal ones the first by name. The score is how much smaller it is than the second, as a share; narrow margins are
rejected (``accepted`` is false).

A null text, or one without a letter, has the language ``und`` and score 0. With a single known language the score is 1;
without any, all texts are ``und``. Ties go to the first language by name. Repeated rows get equal results, an empty
table none. Very long texts are compressed chunk by chunk. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.statistics import held_out
from ledgerline.llm.words import slices

SAMPLE_DOCS = 400
PIECES = 3
DICTIONARY_BYTES = 192 << 10
CHUNK_BYTES = 4 << 10
SETTINGS = {
    "strategy": zstandard.STRATEGY_GREEDY, "min_match": 4, "search_log": 4, "hash_log": 17, "chain_log": 18,
    "window_log": 19, "write_content_size": False, "write_checksum": False, "write_dict_id": False,
}
LEAST_MARGIN = 0.02
UNKNOWN = "und"


def dictionaries(docs: DataFrame, sample: int = SAMPLE_DOCS) -> dict[str, bytes]:
    """Raw contents by language, from a bounded sample of the rows that are not held out."""
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out())
    known = known.select(F.col("lang").cast("string").alias("lang"), F.lower(F.col("text").cast("string")).alias("text"))
    known = known.withColumn("h", F.xxhash64("text"))
    counts = {row["lang"]: row["count"] for row in known.select("lang", "h").distinct().groupBy("lang").count().collect()}
    if not counts:
        return {}
    parts = 1 << 30

    def by_language(value) -> F.Column:
        return F.create_map(*[x for lang, n in counts.items() for x in (F.lit(lang), F.lit(value(n)))])[F.col("lang")]

    drawn = F.pmod(F.xxhash64("h"), F.lit(parts)) < by_language(lambda n: int(min(1.0, sample / n) * parts))
    size = by_language(lambda n: -(-DICTIONARY_BYTES // (PIECES * min(n, sample))))
    spare = F.greatest(F.length("text") - size, F.lit(0))
    cuts = [F.substring(F.col("text"), F.floor(spare * i / (PIECES - 1)).cast("int") + 1, size) for i in range(PIECES)]
    pieces = F.when(F.length("text") <= size * PIECES, F.col("text")).otherwise(F.concat_ws("\n", *cuts))
    # Copies meet before anything is sent: a text that all rows share is one row.
    rows = known.filter(drawn).groupBy("lang", "h").agg(F.min(pieces).alias("text")).collect()
    texts: dict[str, list[str]] = {lang: [] for lang in counts}
    for row in rows:
        texts[row["lang"]].append(row["text"])
    result = {}
    for lang in sorted(texts):
        ordered = "\n".join(sorted(texts[lang], key=lambda text: (_spread(text), text))) or lang
        result[lang] = ordered.encode()[-DICTIONARY_BYTES:].ljust(8)
    return result


def _spread(text: str) -> int:
    """An order that depends on nothing but the text, and not on its first letters."""
    return zlib.crc32(text.encode())


def classify(docs: DataFrame, contents: dict[str, bytes], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, lang_pred, score, accepted) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(contents)
    letter = regex.compile(r"\p{L}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = {}
        for lang, content in shared.value.items():
            dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            settings = zstandard.ZstdCompressionParameters.from_level(5, **SETTINGS)
            compressors[lang] = zstandard.ZstdCompressor(compression_params=settings, dict_data=dictionary).compress

        def judge(text: str | None) -> tuple[str, float]:
            if text is None or not compressors or not letter.search(text):
                return UNKNOWN, 0.0
            raw = text.lower().encode()
            chunks = [raw[at : at + CHUNK_BYTES] for at in range(0, len(raw), CHUNK_BYTES)]
            sizes = sorted((sum(len(compress(x)) for x in chunks), lang) for lang, compress in compressors.items())
            best, lang = sizes[0]
            return lang, (sizes[1][0] - best) / sizes[1][0] if len(sizes) > 1 else 1.0

        for part in slices(batches, "text"):
            found = [judge(text) for text in part.column(1).to_pylist()]
            langs, scores = [x for x, _ in found], [x for _, x in found]
            accepted = [lang != UNKNOWN and score >= LEAST_MARGIN for lang, score in found]
            columns = [part.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(accepted, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang_pred", "score", "accepted"])

    wanted = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    kind = wanted.schema["doc_id"].dataType.simpleString()
    found = wanted.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double, accepted boolean")
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "accepted")

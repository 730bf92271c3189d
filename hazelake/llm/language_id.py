"""Language identification by compression: the language whose dictionary compresses a text best.

Every learned language has a raw-content dictionary: whole training texts of that language, lower-cased and put one
after the other. A text is compressed with each of them; the smallest result names the language, and the relative
margin to the second smallest says how sure that is. Texts of all lengths are judged alike.
"""

from functools import partial

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazelake.llm.common import fold_of, on_plain_names, only, sliced

UNDETERMINED = "und"
#: Content of a language's dictionary, at most.
DICTIONARY_BYTES = 256 << 10
#: Characters of a training piece; a longer text teaches by several pieces.
TRAINING_CHARS = 8192
#: Training pieces drawn for a language, on average; its dictionary takes those that fit.
SAMPLE_PIECES = 1000
LEVEL = 9
#: A text is compressed in pieces, since a long text would otherwise become its own dictionary.
PIECE_BYTES = 4096
#: Compressed sizes are whole bytes, so they are summed over rotations of a text's words until this many are compressed.
LEAST_BYTES = 2400
#: Below this relative margin ``accepted`` rejects a text.
NARROW_MARGIN = 0.004

_LETTER = regex.compile(r"\p{L}")


def learn_dictionaries(
    docs: DataFrame, dictionary_bytes: int = DICTIONARY_BYTES, sample_pieces: int = SAMPLE_PIECES
) -> dict[str, bytes]:
    """Dictionary by language, from the rows of ``docs(doc_id, text, lang, …)`` outside fold 0.

    A bounded sample: of each language about ``sample_pieces`` pieces of texts, drawn by a hash of the id and the place,
    which are taken in hash order while they fit into ``dictionary_bytes``. Texts of any length teach, piece by piece.
    Equal pieces are taken once. Rows without language or text teach nothing. What the driver holds is bounded per
    language by the sample and by the size of a dictionary.
    """
    rows = only(docs, "doc_id", "text", "lang").where(
        F.col("lang").isNotNull() & (fold_of(F.col("doc_id")) != 0) & (F.octet_length("text") > 0)
    )
    chars = min(TRAINING_CHARS, dictionary_bytes // 8)
    pieces = F.ceil(F.length("text") / F.lit(chars)).cast("int")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.sum(pieces).alias("n")).collect()}
    if not sizes:
        return {}
    share = F.create_map(*(F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, sample_pieces / n))))
    draw = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(1 << 30)) / float(1 << 30)
    dealt = rows.withColumn("piece", F.explode(F.sequence(F.lit(0), pieces - 1))).withColumn("draw", draw)
    sample = dealt.where(F.col("draw") < share[F.col("lang")]).select(
        "lang", "draw", F.substring("text", F.col("piece") * chars + 1, F.lit(chars)).alias("text")
    )
    content: dict[str, bytearray] = {lang: bytearray() for lang in sizes}
    seen = set()
    for row in sample.orderBy("draw", "text").toLocalIterator():
        text = row["text"].lower().encode() + b"\n"
        own = content[row["lang"]]
        if len(own) + len(text) <= dictionary_bytes and (row["lang"], text) not in seen:
            seen.add((row["lang"], text))
            own += text
    return {lang: bytes(own) for lang, own in sorted(content.items())}


class Classifier:
    """Compressors of all languages."""

    def __init__(self, dictionaries: dict[str, bytes]):
        settings = zstandard.ZstdCompressionParameters.from_level(
            LEVEL, write_content_size=0, write_checksum=0, write_dict_id=0
        )
        self.compressors = []
        for lang, content in dictionaries.items():
            known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            known.precompute_compress(compression_params=settings)
            self.compressors.append((lang, zstandard.ZstdCompressor(dict_data=known, compression_params=settings)))

    def __call__(self, text: str | None) -> tuple[str, float]:
        if not text or not self.compressors or not _LETTER.search(text):
            return UNDETERMINED, 0.0
        data = text.lower().encode()
        pieces = [data[i : i + PIECE_BYTES] for i in range(0, len(data), PIECE_BYTES)]
        if len(data) < LEAST_BYTES:
            words = data.split() or [data]
            turns = min(len(words), -(-LEAST_BYTES // len(data)))
            pieces = [b" ".join(words[i:] + words[:i]) for i in (k * len(words) // turns for k in range(turns))]
        sizes = sorted((sum(len(c.compress(piece)) for piece in pieces), lang) for lang, c in self.compressors)
        if len(sizes) == 1:
            return sizes[0][1], 1.0
        return sizes[0][1], (sizes[1][0] - sizes[0][0]) / sizes[1][0]


def _classify(batches, dictionaries: dict[str, bytes], text_at: int):
    classify = Classifier(dictionaries)
    for batch in sliced(batches, 512):
        found = [classify(text) for text in batch.column(text_at).to_pylist()]
        langs, scores = pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, langs, scores], names=[*batch.schema.names, "lang_pred", "score"]
        )


def with_language(docs: DataFrame, dictionaries: dict[str, bytes]) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the relative margin between 0 and 1; only ``text`` decides.

    A null text, or one without a letter, is ``und`` with score 0; so is every text if nothing was learned. With one
    learned language the score is 1. Among equal sizes the language that sorts first is named, with score 0.
    Columns of these names that ``docs`` has already are replaced.
    """
    rows = docs.drop("lang_pred", "score")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(
        partial(_classify, dictionaries=dictionaries, text_at=rows.columns.index("text")),
        f"{columns}, lang_pred string, score double",
    )


def predict_languages(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row; fold 0 is held out of what is learned.

    Repeated rows are judged each; a null id counts as held out.
    """
    dictionaries = learn_dictionaries(docs)
    rows = only(docs, "doc_id", "text").withColumn("held_out", fold_of(F.col("doc_id")) == 0)
    return with_language(rows, dictionaries).select("doc_id", "held_out", "lang_pred", "score")


def accepted(docs: DataFrame, margin: float = NARROW_MARGIN) -> DataFrame:
    """The rows of ``docs`` whose language is clear, unchanged: texts without letter and narrow margins go.

    Further columns may have any names.
    """
    clear = (F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= margin)
    return on_plain_names(
        docs, ("doc_id", "text", "lang"), lambda rows: with_language(rows, learn_dictionaries(rows)).where(clear)
    )

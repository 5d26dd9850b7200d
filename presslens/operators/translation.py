"""Translation as a plug-in, and the pass that tries again what was not translated."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from presslens.functions.language import broken_translation, detect, ensure_english

#: Languages that are never translated, the second being Latin writing that nothing was recognised in.
NOT_TRANSLATED = ("en", "xx")
BATCH = 32
Translate = Callable[[list[str], str], list[str | None]]
Run = Callable[[DataFrame, str, str], DataFrame]


def translator(load: Callable[[], Translate], languages: tuple[str, ...] | None = None, batch: int = BATCH) -> Run:
    """A function of rows and the names of their title and language that adds the English title, or null, as a column.

    ``load`` runs once per worker and stream of batches and returns the model: titles of one language to titles. A title is null after
    translation if its language is English, unknown or not in ``languages``, if the model gives nothing, or if its batch failed.
    """

    def made(parts: Iterator[pa.RecordBatch], title: str, code: str) -> Iterator[pa.RecordBatch]:
        model = None
        for part in parts:
            titles, codes = (part.column(part.schema.get_field_index(n)).to_pylist() for n in (title, code))
            out: list[str | None] = [None] * len(titles)
            for spoken in sorted({c for c in codes if c and c not in NOT_TRANSLATED and (languages is None or c in languages)}):
                own = [i for i, c in enumerate(codes) if c == spoken]
                model = model or load()
                for at in range(0, len(own), batch):
                    some = own[at : at + batch]
                    try:
                        said = model([titles[i] or "" for i in some], spoken)
                    except Exception:  # a model that fails on a batch leaves its titles for a later run
                        continue
                    for i, text in zip(some, said, strict=True):
                        out[i] = (text or "").strip() or None
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out, pa.string())], names=[*part.schema.names, "_made"])

    def run(rows: DataFrame, title: str, code: str) -> DataFrame:
        plain = rows.drop("_made")
        return plain.mapInArrow(lambda parts: made(parts, title, code), T.StructType([*plain.schema.fields, T.StructField("_made", T.StringType())]))

    return run


def pending(code: Column, original: Column) -> Column:
    """Not English, and without an original: never translated so far."""
    return ~F.coalesce(code, F.lit("")).isin("", "en") & (F.trim(F.coalesce(original, F.lit(""))) == "")


def broken(title: Column, original: Column) -> Column:
    return (F.trim(F.coalesce(original, F.lit(""))) != "") & broken_translation(title, original)


def counts(rows: DataFrame, title: str = "titre", original: str = "titre_vo", code: str = "langue") -> DataFrame:
    return rows.agg(F.count_if(pending(F.col(code), F.col(original))).alias("n_pending"), F.count_if(broken(F.col(title), F.col(original))).alias("n_broken"))


def translate_rows(rows: DataFrame, run: Run, title: str = "titre", original: str = "titre_vo", code: str = "langue", declared: Column | None = None, words=None) -> DataFrame:
    """``rows`` with title, original and language as a new title gets them."""
    found = run(rows.withColumn("_code", detect(F.col(title), declared, words)), title, "_code")
    found = found.withColumn("_said", ensure_english(F.coalesce(title, F.lit("")), F.col("_made"), F.col("_code")))
    return found.withColumns({title: F.col("_said.title"), original: F.col("_said.original"), code: F.col("_said.language")}).drop("_code", "_made", "_said")


def retry(rows: DataFrame, run: Run, reclassify: Callable[[DataFrame], DataFrame] = lambda d: d, title: str = "titre", original: str = "titre_vo", code: str = "langue", declared: Column | None = None, words=None) -> DataFrame:
    """Rows whose language is unknown, that wait for a translation, or whose translation is broken, tried again from the original.

    A translation that succeeds, or is broken again, goes through ``reclassify`` (which must keep the columns); where none is made the
    readable original stays and waits. All other rows pass untouched.
    """
    known = F.coalesce(code, F.lit(""))
    again = (F.trim(known) == "") | pending(F.col(code), F.col(original)) | broken(F.col(title), F.col(original))
    source = F.when(F.trim(F.coalesce(original, F.lit(""))) != "", F.trim(original)).otherwise(F.coalesce(title, F.lit("")))
    tried = translate_rows(rows.filter(again).withColumn(title, source), run, title, original, code, declared, words)
    done = reclassify(tried.filter(F.col(original) != "")).select(*rows.columns)
    return rows.filter(~again).unionByName(done).unionByName(tried.filter(F.col(original) == "").select(*rows.columns))

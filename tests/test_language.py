"""Language rules over whole texts."""

from presslens.functions import language
from presslens.plans import registry


def test_script_after_the_first_characters(spark, tmp_path):
    rows = [(3, "a" * 60 + " мир"), (7, "a" * 60 + " αβγ"), (11, "a" * 60)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert {r.doc_id: r.script for r in registry.QUERIES["lang_script"](spark, str(tmp_path)).collect()} == {3: "ru", 7: "el", 11: None}


def test_languages_of_the_survey(spark):
    said = {"id": "berita itu adalah karena", "tr": "haber çok ama göre", "hu": "az amely pedig", "ro": "este foarte între", "cs": "že když bylo", "sv": "jag hade mycket", "da": "og ikke til", "fi": "hän niin kuin", "hr": "kao ali gdje čuje", "pl": "nie jest oraz", "de": "auch sich werden", "en": "kao ali gdje", "el": "aa ἀ"}
    frame = spark.createDataFrame(list(said.items()), "want string, text string")
    from pyspark.sql import functions as F

    assert {r.want: r.got for r in frame.select("want", language.detect(F.col("text")).alias("got")).collect()} == {c: c for c in said}

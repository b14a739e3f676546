"""Raw record files: one pass over what makes them and over what is read."""

from pyspark.sql import functions as F

from catalog import files
from tariffworks.schemas import RAW_RECORD
from tariffworks.sources.readers import read_raw_json


def test_rejects_read_the_files_once(spark, tmp_path, capsys):
    texts = {"array": '[{"docket_number": "1"}, 7, {"docket_number": "2"}]', "single": '{"docket_number": "3"}', "cut": '[{"docket_numb',
             "empty": "[]", "null": "null", "blank": " "}
    for name, text in texts.items():
        (tmp_path / f"{name}.json").write_text(text)
    records, rejects = read_raw_json(spark, str(tmp_path))
    assert sorted(r["docket_number"] for r in records.collect()) == ["1", "2", "3"]
    found = {(r["file"].rsplit("/", 1)[1].split(".")[0], r["place"], r["reason"], r["text"]) for r in rejects.collect()}
    assert found == {("array", 1, "not a record", "7"), ("null", 0, "not a record", "null"),
                     ("cut", None, "malformed file", texts["cut"]), ("blank", None, "malformed file", " ")}
    capsys.readouterr()
    rejects.explain()
    assert capsys.readouterr().out.count("FileScan text") == 1


def test_raw_files_are_derived_once(spark, monkeypatch):
    made = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(seq):
        made.add(1)
        return str(seq)

    rows = spark.range(2005).select(F.col("id").alias("seq"), *[
        (counted("id") if f.name == "docket_number" else F.lit("x")).alias(f.name) for f in RAW_RECORD.fields])
    monkeypatch.setattr(files.A, "raw_records", lambda s, d: rows)
    records, rejects = files._raw_files(spark, "")
    assert made.value == 2005
    assert records.count() == 2005
    assert rejects.count() == 3

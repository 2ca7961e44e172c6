"""CSV files by their own headers; dimensions from vocabularies; constants of long files."""

from pyspark.sql import functions as F

from surveyloom import vocab
from surveyloom.sources import imports as I


def test_files_with_other_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("﻿Datum,Institut,CDU,SPD\n2024-01-01,INSA,30,20\n\n2024-01-02,\"For,sa\",31\n2024-01-03,X,1,2,3\n".encode())
    (tmp_path / "b.csv").write_text("Institut, Datum ,SPD,CDU,,FDP\nINSA,2024-02-01, 21 ,32,z,5\n")
    (tmp_path / "c.csv").write_text('Datum,Institut,CDU,SPD\n2024-03-01,"two\nlines ""x""",33,22\n2024-03-02,Y,34,\n')
    (tmp_path / "d.csv").write_text("")
    rows, broken = I.read_csv_files(spark, str(tmp_path))
    got = {r["Datum"]: (r["Institut"], r["CDU"], r["SPD"], r["FDP"]) for r in rows.collect()}
    assert got == {"2024-01-01": ("INSA", "30", "20", None), "2024-02-01": ("INSA", "32", "21", "5"), "2024-03-01": ('two\nlines "x"', "33", "22", None), "2024-03-02": ("Y", "34", None, None)}
    assert sorted((r["file"][-5:], r["row"]) for r in broken.collect()) == [("a.csv", '2024-01-02,"For,sa",31'), ("a.csv", "2024-01-03,X,1,2,3")]
    imported = {r["publish_date"]: (r["institute_id"], r["parties"]) for r in I.csv_import(rows).collect()}
    assert imported["2024-02-01"] == ("INSA", {"CDU": "32", "SPD": "21", "FDP": "5"}) and imported["2024-01-01"][1] == {"CDU": "30", "SPD": "20"}


def test_large_file_is_read_in_parts(spark, tmp_path):
    (tmp_path / "big.csv").write_text("Datum,SPD\n" + "".join(f"2024-01-{i % 28 + 1:02d},{i % 40}\n" for i in range(60_000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    try:
        rows, broken = I.read_csv_files(spark, str(tmp_path))
        assert rows.rdd.getNumPartitions() > 2 and rows.count() == 60_000 and broken.count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_dimensions_of_the_vocabularies(spark):
    dims = I.dimensions(spark, {"SPD": {"wikidata": "Q49768"}})
    assert set(dims) == {"institutes", "parties", "states"} and dims["institutes"].count() == len(vocab.INSTITUTES)
    parties = {r["key"]: r for r in dims["parties"].collect()}
    assert parties["SPD"]["external_ids"] == {"wikidata": "Q49768"} and parties["CDU_CSU"]["external_ids"] == {} and set(vocab.PARTY_ALIASES.values()) <= set(parties)
    old = dims["parties"].filter("key <> 'FDP'").withColumn("name", F.when(F.col("key") == "SPD", "old").otherwise(F.col("name")))
    merged, counts = I.upsert_dimension(old, dims["parties"], "key")
    assert {r["action"]: r["n"] for r in counts.collect()} == {"new": 1, "changed": 1, "same": len(parties) - 2}
    assert {r["key"]: r["name"] for r in merged.collect()} == {k: r["name"] for k, r in parties.items()}


def test_long_rows_have_their_constants(spark):
    rows = spark.createDataFrame([("DEU", "2024-01-01", "Emnid", "SPD", "20,5"), ("AUT", "2024-01-01", "Emnid", "SPD", "1")], "country_iso3c string, survey_date string, institute string, party_name_short string, poll string")
    (r,) = I.long_import(rows).collect()
    assert (r["institute_id"], r["parties"], r["scope"], r["election_id"], r["method_id"]) == ("Verian (Emnid)", {"SPD": "20.5"}, "Bund", "Bundestagswahl", "99")

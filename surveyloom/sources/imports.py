"""Reading raw rows (A): source catalogues, JSON dumps, CSV with header aliases, long files; and exports."""

from __future__ import annotations

import csv
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import vocab
from ..functions.survey import day_first, iso_date, lookup


def catalogue(entries: DataFrame) -> DataFrame:
    """A4: a source catalogue with active and survey_type: a class runs if its name ends in Scraper; a survey type, however its key is written, is kept, else it is a projection."""
    own = [c for c in entries.columns if c.lower() == "survey_type"]
    kind = F.coalesce(*[F.nullif(F.trim(F.col(c)), F.lit("")) for c in own], F.lit("Projektion"))
    return entries.select(*[c for c in entries.columns if c not in own], kind.alias("survey_type"), F.coalesce(F.col("class_name").endswith("Scraper"), F.lit(False)).alias("active"))


def enrich_by_worker(rows: DataFrame, catalogue: DataFrame) -> DataFrame:
    """A4: the catalogue's state, scope, institute, provider and survey_type beside each row, by worker.

    catalogue has one row per worker and own_institute, true for state pages: there the row's
    institute counts if it isn't null.  Rows of an unknown or null worker get nulls.
    """
    c = catalogue.select(F.col("worker").alias("__worker"), *[F.col(x).alias(f"__{x}") for x in ("state", "scope", "institute", "provider", "survey_type", "own_institute")])
    institute = F.when(F.col("__own_institute"), F.coalesce("institute", "__institute")).otherwise(F.col("__institute"))
    out = rows.join(c, F.col("worker") == F.col("__worker"), "left").withColumn("institute", institute)
    given = [x for x in rows.columns if x not in ("state", "scope", "provider", "survey_type")]
    return out.select(*given, *[F.col(f"__{x}").alias(x) for x in ("state", "scope", "provider", "survey_type")])


_DUMP = """Parliaments map<string, struct<Shortcut:string>>, Institutes map<string, struct<Name:string>>, Taskers map<string, struct<Name:string>>, Methods map<string, struct<Name:string>>, Parties map<string, struct<Shortcut:string>>,
  Surveys map<string, struct<Date:string, Surveyed_Persons:string, Parliament_ID:string, Institute_ID:string, Tasker_ID:string, Method_ID:string, Survey_Period:struct<Date_Start:string, Date_End:string>, Results:map<string,string>>>"""


def last_of_each(entries: Column) -> Column:
    """A map of (key, value) entries; of entries that share a key the last one."""
    return F.map_from_entries(F.filter(entries, lambda e, i: ~F.exists(F.slice(entries, i + 2, F.size(entries)), lambda x: x["key"] == e["key"])))


def flatten_dump(dumps: DataFrame, column: str, on_empty: str = "error") -> DataFrame:
    """A5: a row for each entry of the ``Surveys`` map of a JSON dump, with the names that the dump's own tables give to its ids.

    A name that isn't found is null; the survey is kept.  Results are keyed by party
    shortcuts (an unknown party's id stays), those that are no numbers are dropped.  A dump
    without surveys, or that is no JSON, is an error (on_empty="skip": it gives no rows).
    """
    d = dumps.select(F.from_json(column, _DUMP).alias("d")).select("d.*")
    if on_empty == "error":
        d = d.withColumn("Surveys", F.when(F.coalesce(F.size("Surveys"), F.lit(0)) > 0, F.col("Surveys")).otherwise(F.raise_error(F.lit("a dump holds no surveys"))))
    d = d.select("*", F.explode("Surveys").alias("survey_id", "s"))
    name = lambda table, key, part: F.try_element_at(table, F.coalesce(key, F.lit("")))[part]
    numbers = F.transform(F.map_entries("s.Results"), lambda e: F.struct(F.coalesce(name("Parties", e["key"], "Shortcut"), e["key"]).alias("key"), e["value"].try_cast("double").alias("value")))
    return d.select(
        "survey_id", "s.Date", "s.Surveyed_Persons", name("Parliaments", F.col("s.Parliament_ID"), "Shortcut").alias("Parliament"), name("Institutes", F.col("s.Institute_ID"), "Name").alias("Institute"),
        name("Taskers", F.col("s.Tasker_ID"), "Name").alias("Tasker"), name("Methods", F.col("s.Method_ID"), "Name").alias("Method"),
        last_of_each(F.filter(numbers, lambda e: e["value"].isNotNull())).alias("parties"), F.col("s.Survey_Period.Date_Start").alias("survey_date_start"), F.col("s.Survey_Period.Date_End").alias("survey_date_end"),
    )


def rename_and_tag(rows: DataFrame, names: dict[str, str], constants: dict[str, str]) -> DataFrame:
    """Renamed columns, then constant ones."""
    return rows.withColumnsRenamed(names).withColumns({k: F.lit(v) for k, v in constants.items()}).select(*names.values(), *constants)


def pick_aliases(rows: DataFrame, aliases: dict[str, tuple[str, ...]], defaults: dict[str, str], keep: Iterable[str] = ()) -> DataFrame:
    """Each field is its first alias, by trimmed lower-cased header, that isn't empty; else the default."""
    have = {c.strip().lower(): c for c in rows.columns}
    filled = lambda c: F.nullif(F.trim(F.col(f"`{c}`")), F.lit(""))
    out = [F.coalesce(*[filled(have[a]) for a in names if a in have], F.lit(defaults.get(field)).cast("string")).alias(field) for field, names in aliases.items()]
    return rows.select(*keep, *out)


def csv_headers(spark: SparkSession, path: str) -> DataFrame:
    """(file, header, quoted_ends) of the CSV files under a path: their first line, and whether a quoted text in them goes over a line's end."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"))
    odd = F.length(F.regexp_replace("value", '[^"]', "")) % 2 == 1
    # A file's first part is read by one task, line by line: its first line is the header.
    return lines.groupBy("file").agg(F.first(F.when(F.col("at") == 0, F.col("value")), ignorenulls=True).alias("header"), F.max(odd).alias("quoted_ends"))


def read_csv_files(spark: SparkSession, path: str, delimiter: str = ",") -> tuple[DataFrame, DataFrame]:
    """(rows, quarantine) of CSV files, each read by its own header.

    rows holds all columns of all files as trimmed text, null where a file has none; a byte order
    mark is no part of a header, nor are columns without a name, and of columns that share one
    the last counts.  quarantine holds (file, row): the text of rows that have other than as many
    cells as their header.  Files of one header are read together, in parts; only a file in which
    a quoted text goes over the end of a line is read by one task.  A header is one line; files without one are left out.  The
    driver holds the files' names and headers, as it does for any read.
    """
    groups: dict[tuple[str, bool], list[str]] = {}
    for r in csv_headers(spark, path).orderBy("file").collect():
        groups.setdefault((r["header"] or "", r["quoted_ends"]), []).append(r["file"])
    parts, broken = [], []
    for (header, whole), files in groups.items():
        names = [c.lstrip("\ufeff").strip() for c in next(csv.reader([header], delimiter=delimiter), [])]
        if not any(names):
            continue
        cells = [f"c{i}" for i in range(len(names))]
        schema = ", ".join(f"{c} string" for c in cells) + ", broken string"
        reader = spark.read.schema(schema).options(header=True, sep=delimiter, quote='"', escape='"', multiLine=whole, ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True, columnNameOfCorruptRecord="broken", columnPruning=False)
        read = reader.csv(files).withColumn("file", F.col("_metadata.file_path"))
        last = {name: c for name, c in zip(names, cells, strict=True) if name}
        # Spark reads the column of broken rows only beside others.
        beside = F.length(F.concat_ws("", *cells)) >= 0
        parts.append(read.filter(F.col("broken").isNull() & beside).select(*[F.col(c).alias(name) for name, c in last.items()]))
        broken.append(read.filter(F.col("broken").isNotNull() & beside).select("file", F.col("broken").alias("row")))
    if not parts:
        return spark.createDataFrame([], ""), spark.createDataFrame([], "file string, row string")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts), reduce(DataFrame.unionByName, broken)


def read_csv(spark: SparkSession, path: str, delimiter: str = ",") -> DataFrame:
    """The rows of read_csv_files()."""
    return read_csv_files(spark, path, delimiter)[0]


def csv_import(rows: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """The raw columns of CSV rows by header aliases, with defaults, the parties map, and parties_error (null, or why a row has no parties)."""
    reserved = {a for names in vocab.CSV_FIELDS.values() for a in names} | set(vocab.CSV_PARTIES) | {k.lower() for k in keep}
    return pick_aliases(unpivot_parties(rows, reserved), vocab.CSV_FIELDS, vocab.CSV_DEFAULTS, [*keep, "parties", "parties_error"])


def unpivot_parties(rows: DataFrame, reserved: set[str], json_columns: tuple[str, ...] = vocab.CSV_PARTIES) -> DataFrame:
    """Adds parties, a map, and parties_error: the first JSON column with text if it holds an object, else all other columns with text."""
    given = [c for name in json_columns for c in rows.columns if c.strip().lower() == name]
    text = F.coalesce(*[F.nullif(F.trim(F.col(f"`{c}`")), F.lit("")) for c in given], F.lit(None).cast("string"))
    others = [c for c in rows.columns if c.strip().lower() not in reserved and c not in given]
    entries = F.filter(F.array(*[F.struct(F.lit(c.strip()).alias("key"), F.trim(F.col(f"`{c}`")).alias("value")) for c in others]), lambda e: F.coalesce(e["value"], F.lit("")) != "") if others else F.array().cast("array<struct<key:string,value:string>>")
    read = F.from_json(text, "map<string,string>")
    parties = F.when(text.isNotNull(), read).when(F.size(entries) > 0, F.map_from_entries(entries))
    error = F.when(text.isNotNull() & read.isNull(), "the party results are no JSON object").when(text.isNull() & (F.size(entries) == 0), "there is no column with party results")
    return rows.withColumns({"parties": parties, "parties_error": error})


def grouped_import(rows: DataFrame, keys: list[str], party: str, value: str) -> DataFrame:
    """One row a group with its map of values; a group in which a party has several values is dropped whole."""
    per = rows.filter(F.col(party).isNotNull() & F.col(value).isNotNull()).groupBy(*keys, party).agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    return per.groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(party).alias("key"), F.col("lo").alias("value"))))).alias("parties"), F.max(F.col("lo") != F.col("hi")).alias("torn")).filter(~F.col("torn")).drop("torn")


def long_import(rows: DataFrame) -> DataFrame:
    """(publish_date, institute_id, parties, provider, source, scope, election_id, method_id, worker) of a long file's rows (country_iso3c, survey_date, institute, party_name_short, poll).

    Rows of other countries, of parties without a name here and without a value are left out;
    groups whose parties contradict themselves, without a date that can be read, or without
    parties are dropped.
    """
    blank = lambda c: F.coalesce(F.trim(c), F.lit(""))
    own = rows.filter(blank("country_iso3c") == vocab.LONG_COUNTRY)
    own = own.select(F.trim("survey_date").alias("day"), blank("institute").alias("name"), lookup(vocab.LONG_PARTIES, F.trim("party_name_short")).alias("party"), number_text(F.col("poll")).alias("value"))
    groups = grouped_import(own, ["day", "name"], "party", "value").withColumn("publish_date", long_date(F.col("day"))).filter("publish_date is not null")
    return groups.select("publish_date", institute_text(F.col("name")).alias("institute_id"), "parties", *[F.lit(v).alias(k) for k, v in vocab.LONG_ROW.items()])


def long_date(c: Column) -> Column:
    """A10: an ISO date, with midnight or without, or a day-first date."""
    t = F.trim(c)
    return F.coalesce(iso_date(F.regexp_replace(t, r"\s+00:00:00$", "")), day_first(t))


def number_text(c: Column) -> Column:
    """A10: a number with comma or dot as text: whole ones without decimals, others with at most six and no zero at the end; null if it is none."""
    n = F.replace(F.trim(c), F.lit(","), F.lit(".")).try_cast("double")
    return F.when(n == F.floor(n), n.cast("decimal(38,0)").cast("string")).when(n.isNotNull(), F.regexp_replace(F.regexp_replace(F.format_string("%.6f", n), "0+$", ""), r"\.$", ""))


def institute_text(c: Column) -> Column:
    """A10: an institute's name here: without what marks an archive, an intermediate result or a model at its end; Unknown if empty."""
    t = F.trim(F.substring_index(F.trim(c), " Archived ", 1))
    for end in ("(intermediate result)", "(MRP)"):
        t = F.when(t.endswith(end), F.trim(F.substring(t, F.lit(1), F.length(t) - len(end)))).otherwise(t)
    return F.when(F.coalesce(t, F.lit("")) == "", "Unknown").otherwise(F.coalesce(lookup(vocab.LONG_INSTITUTES, t), t))


def payload_filter(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows whose parties are an object of numbers, all others); respondents of more than 40 characters become null."""
    m = F.from_json("parties", "map<string,double>")
    ok = F.coalesce(m.isNotNull() & (F.size(m) > 0) & F.forall(F.map_values(m), lambda v: v.isNotNull()), F.lit(False))
    marked = rows.withColumn("__ok", ok).withColumn("respondents", F.when(F.length("respondents") <= 40, F.col("respondents")))
    return marked.filter("__ok").drop("__ok"), marked.filter(~F.col("__ok")).drop("__ok")


def raw_rows(rows: DataFrame) -> DataFrame:
    """Raw rows from read ones (id, respondents, zeitraum, parties map, and if there source, method_id).

    Blanks become null; where respondents are empty an election in the time frame clears it,
    and a count in it moves.  Parties become JSON sorted by name; source and method have defaults.
    """
    blank = lambda c: F.nullif(F.trim(c), F.lit(""))
    r, z = blank(F.col("respondents")), blank(F.col("zeitraum"))
    voting, count = r.isNull() & F.lower(z).contains("wahl"), r.isNull() & F.replace(z, F.lit(" "), F.lit("")).rlike(r"^\d+([.,]\d+)*$")
    parties = F.to_json(F.map_from_entries(F.array_sort(F.map_entries("parties"))))
    given = lambda name, default: F.coalesce(blank(F.col(name)) if name in rows.columns else F.lit(None).cast("string"), F.lit(default)).alias(name)
    return rows.select(
        "id", F.when(count & ~F.coalesce(voting, F.lit(False)), z).otherwise(r).alias("respondents"), F.when(~F.coalesce(voting | count, F.lit(False)), z).alias("zeitraum"), parties.alias("parties"), given("source", "html_scraper"), given("method_id", "99"),
    )


def manifest(tables: dict[str, DataFrame], formats: Iterable[str] = ("json", "csv", "parquet")) -> DataFrame:
    """One row with the number of rows of each table, and the names of their files."""
    counts = reduce(lambda a, b: a.crossJoin(b), [df.agg(F.count("*").alias(name)) for name, df in tables.items()])
    return counts.withColumn("files", F.lit(",".join(f"{name}.{kind}" for name in tables for kind in formats)))


def dimension(spark: SparkSession, names: dict[str, str], external_ids: dict[str, dict[str, str]] | None = None) -> DataFrame:
    """(key, name, external_ids) of a vocabulary; a key without external ids has an empty map."""
    rows = [(key, name, (external_ids or {}).get(key, {})) for key, name in names.items()]
    return spark.createDataFrame(rows, "key string, name string, external_ids map<string,string>")


def dimensions(spark: SparkSession, party_ids: dict[str, dict[str, str]] | None = None) -> dict[str, DataFrame]:
    """The reference dimensions of the vocabularies; parties have a short_name and what party_ids gives of external ids."""
    short = spark.createDataFrame([(key, short) for key, (_, short) in vocab.PARTIES.items()], "key string, short_name string")
    parties = dimension(spark, {key: name for key, (name, _) in vocab.PARTIES.items()}, party_ids)
    return {"institutes": dimension(spark, vocab.INSTITUTES), "parties": parties.join(F.broadcast(short), "key"), "states": dimension(spark, vocab.STATE_NAMES)}


def upsert_dimension(old: DataFrame, new: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(the dimension with new and changed members of new, their numbers by action)."""
    changes = dimension_changes(old, new, key)
    kept = old.join(new.select(key), key, "left_anti").select(*new.columns)
    return kept.unionByName(changes.drop("action")), changes.groupBy("action").agg(F.count("*").alias("n"))


def dimension_changes(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """New rows with their action: new, changed or same."""
    values = [c for c in new.columns if c != key]
    o = old.select(F.col(key).alias("__k"), *[F.col(c).alias(f"__{c}") for c in values])
    # Maps have no equality: they are compared as sorted entries.
    plain = lambda c: F.array_sort(F.map_entries(c)) if dict(new.dtypes)[c.removeprefix("__")].startswith("map") else F.col(c)
    same = reduce(lambda a, b: a & b, [plain(c).eqNullSafe(plain(f"__{c}")) for c in values], F.lit(True))
    return new.join(o, F.col(key) == F.col("__k"), "left").select(*new.columns, F.when(F.col("__k").isNull(), "new").when(same, "same").otherwise("changed").alias("action"))


def flat_cells(df: DataFrame) -> DataFrame:
    """Nested cells as JSON text."""
    return df.select(*[F.to_json(f.name).alias(f.name) if f.dataType.typeName() in ("array", "map", "struct") else F.col(f.name) for f in df.schema.fields])


def export(df: DataFrame, base: str) -> None:
    """The dataset as JSON (nested), CSV and Parquet (nested cells as JSON text)."""
    df.write.mode("overwrite").json(f"{base}/json")
    flat = flat_cells(df)
    flat.write.mode("overwrite").option("header", True).option("escape", '"').csv(f"{base}/csv")
    flat.write.mode("overwrite").parquet(f"{base}/parquet")

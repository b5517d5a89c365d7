"""Registered queries over files and streams that Spark writes from the tables.

Each writes what a source would hold into the shared folder, runs the operator on it, and returns
the result as a table, so that the answer can be compared with SQL over the same tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from matchday import schema
from matchday.functions import scalars
from matchday.operators.preceding import before
from matchday.plans import strict
from matchday.plans.publish import publish
from matchday.session import SETTINGS, scratch_folder
from matchday.sources import files
from matchday.sources.fixture import matches, records
from matchday.sources.messages import to_messages
from matchday.sources.streams import stream
from matchday.streaming import incremental, jobs, sinks
from matchday.streaming.carried import form_with_carry
from matchday.streaming.copies import without_copies
from matchday.streaming.last_five import form_and_late, last_five, split_late, tails
from matchday.streaming.running_totals import add_up, totals_before
from matchday.streaming.snapshots import begin, read_log, vacuum

BATCHES = 4
PAIR = ["league", "season"]


# --- files ---------------------------------------------------------------------------------------

def _csv_folder(spark: SparkSession, folder: str) -> str:
    """CSV files by league and season in two layouts: odd matches have no cards and another order."""
    path = scratch_folder(spark, "csv")
    rows = records(spark, folder).withColumns({"league": F.col("League"), "season": F.col("Season")})
    wide = ["match_id", "Date", "HomeTeam", "AwayTeam", "FTR", "FTHG", "FTAG", "HY", "AY"]
    for odd, names in ((0, wide), (1, ["Date", "match_id", "FTAG", "FTHG", "FTR", "HomeTeam", "AwayTeam"])):
        (
            rows.where(F.col("match_id") % 2 == odd)
            .select(*names, *PAIR)
            .hint("rebalance", *PAIR)
            .write.mode("append")
            .partitionBy(*PAIR)
            .csv(path, header=True)
        )
    return path


def csv_scan(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_folder(spark, "csv")
    columns = ["match_id", "HomeTeam", "FTHG", "FTR"]
    records(spark, folder).select(*columns).write.csv(path, header=True)
    rows = scalars.cast_stats(files.csv_scan(spark, path), ["FTHG"])
    return rows.select(
        F.col("match_id").try_cast("bigint").alias("match_id"),
        F.col("HomeTeam").alias("home_team"),
        F.col("FTHG").alias("fthg"),
        F.col("FTR").alias("ftr"),
    )


def csv_union_by_name(spark: SparkSession, folder: str) -> DataFrame:
    """Also the file gate (none is left out here) and the provenance columns."""
    rows = files.csv_union(spark, _csv_folder(spark, folder), min_bytes=0, pattern=files.FOLDER_NAME)
    return scalars.cast_stats(rows, ["FTHG", "FTAG", "HY", "AY"]).select(
        F.col("match_id").try_cast("bigint").alias("match_id"),
        F.col("Season").alias("season"),
        F.col("League").alias("league"),
        F.col("HomeTeam").alias("home_team"),
        F.col("AwayTeam").alias("away_team"),
        *[F.col(name).alias(name.lower()) for name in ["FTR", "FTHG", "FTAG", "HY", "AY"]],
    )


def bronze_raw(spark: SparkSession, folder: str) -> DataFrame:
    """Lines kept per season and league. Headers, of which every file has one, are left out of the result."""
    source, kept = _csv_folder(spark, folder), scratch_folder(spark, "bronze")
    files.write_bronze(files.raw_lines(spark, source, 0, files.FOLDER_NAME), kept)
    lines = sinks.read_partitions(spark, kept, PAIR)
    return lines.where(~F.col("line").contains("FTHG")).select("season", "league", "line")


HEADER = "match_id,Date,HomeTeam,AwayTeam,FTR,FTHG,FTAG"


def _line_folder(spark: SparkSession, folder: str, line: Column) -> str:
    """One CSV file per league and season with HEADER and a line per match."""
    path, rows = scratch_folder(spark, "lines"), records(spark, folder)
    pair = {"league": F.col("League"), "season": F.col("Season")}
    lines = rows.withColumns(pair).select(*PAIR, F.lit(1).alias("place"), line.alias("line"))
    heads = lines.select(*PAIR).distinct().select(*PAIR, F.lit(0).alias("place"), F.lit(HEADER).alias("line"))
    both = heads.union(lines).repartition(*PAIR).sortWithinPartitions(*PAIR, "place").drop("place")
    # no line has this separator or quotes, so lines are written as they are
    both.write.partitionBy(*PAIR).option("sep", "\u0001").option("escapeQuotes", False).csv(path)
    return path


def _whole_line() -> Column:
    return F.concat_ws(",", *[F.coalesce(F.col(name), F.lit("")) for name in HEADER.split(",")])


def csv_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """Lines with cells too many, with too few, of commas alone, and without a team are kept apart with the reason."""
    line, match = _whole_line(), F.col("match_id")
    damaged = (
        F.when(match % 37 == 0, F.concat(line, F.lit(",x,y")))
        .when(match % 41 == 0, F.substring_index(line, ",", 5))
        .when(match % 43 == 0, F.lit(",,,,,,"))
        .when(match % 47 == 0, F.concat_ws(",", "match_id", "Date", F.lit(""), "AwayTeam", F.lit("H,1,0")))
        .otherwise(line)
    )
    rows = files.csv_flagged(spark, _line_folder(spark, folder, damaged), 0, files.FOLDER_NAME)
    good = F.col("reason").isNull()
    kept = [F.when(good, F.col(name)).alias(name.lower()) for name in HEADER.split(",")]
    return rows.select("Season", "League", "reason", F.when(~good, F.col("raw")).alias("raw"), *kept).withColumnsRenamed(
        {"Season": "season", "League": "league"}
    )


GATE_ROWS, GATE_WIDTH = 100, 60


def file_gate(spark: SparkSession, folder: str) -> DataFrame:
    """Files of lines of one length; those with fewer than GATE_ROWS matches are too small."""
    path = _line_folder(spark, folder, F.rpad(_whole_line(), GATE_WIDTH, "#"))
    # the header and the line feeds count as well
    smallest = len(HEADER) + 1 + GATE_ROWS * (GATE_WIDTH + 1) - 1
    listed = files.accepted(files.list_files(spark, path), smallest)
    return files.provenance(listed, "path", files.FOLDER_NAME).select(
        F.col("Season").alias("season"), F.col("League").alias("league"),
        ((F.col("length") - len(HEADER) - 1) / (GATE_WIDTH + 1)).cast("bigint").alias("rows"),
    )


def publish_run(spark: SparkSession, folder: str) -> DataFrame:
    """The report of a run in which one file cannot be read, and the messages that were sent by pair."""
    path, sent = _line_folder(spark, folder, _whole_line()), scratch_folder(spark, "sent")
    # a file that says that it is compressed and is not
    broken = spark.range(1).select(F.lit("no file ").alias("line"), F.lit("E0").alias("league"), F.lit("9900").alias("season"))
    broken.write.mode("append").partitionBy(*PAIR).option("compression", "none").csv(path)
    _rename_parts(spark, f"{path}/league=E0/season=9900", ".csv", ".csv.gz")
    report = publish(spark, path, "json", {"path": sent}, min_bytes=0, pattern=files.FOLDER_NAME)
    message = F.from_json("value", schema.SHORT_MESSAGE)
    counts = spark.read.schema("value string").json(sent).select(message.alias("m")).groupBy(
        F.col("m.Season").alias("season"), F.col("m.League").alias("league")
    ).agg(F.count("*").alias("sent"))
    return report.join(counts, ["season", "league"], "left").select(
        "season", "league", "rows", "status", F.coalesce("sent", F.lit(0)).alias("sent"),
        F.col("reason").isNotNull().alias("explained"),
    )


def _rename_parts(spark: SparkSession, place: str, old: str, new: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path
    store = path(place).getFileSystem(spark._jsc.hadoopConfiguration())
    for status in store.listStatus(path(place)):
        name = status.getPath().getName()
        if name.endswith(old):
            store.rename(status.getPath(), path(place, name.removesuffix(old) + new))


# --- streams -------------------------------------------------------------------------------------

def _write_topic(rows: DataFrame, path: str) -> None:
    """JSON messages in several files, also where one task holds the whole table."""
    per_file = max(1, -(-rows.count() // (2 * BATCHES)))
    rows.write.mode("append").option("maxRecordsPerFile", per_file).json(path)


def _read_topic(spark: SparkSession, path: str, fields: str) -> DataFrame:
    """The files of a topic in about ``BATCHES`` micro-batches."""
    count = files.list_files(spark, path).where(F.col("path").endswith(".json")).count()
    options = {"path": path, "maxFilesPerTrigger": str(max(1, -(-count // BATCHES)))}
    return stream(spark, "json", options, fields)


def _finish(query: StreamingQuery) -> None:
    query.awaitTermination()


def _messages(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_folder(spark, "topic")
    sent = to_messages(records(spark, folder).drop("match_ts"), ["match_id"])
    _write_topic(sent.select("value", F.col("match_id").alias("offset")), path)
    return _read_topic(spark, path, "value string, offset bigint")


def _flat(rows: DataFrame) -> DataFrame:
    return scalars.cast_stats(rows, ["FTHG", "FTAG"]).select(
        scalars.match_date(F.col("Date")).alias("match_date"),
        *[F.col(name).alias(new) for name, new in _FLAT.items()],
    )


_FLAT = {
    "Season": "season", "League": "league", "HomeTeam": "home_team", "AwayTeam": "away_team",
    "FTR": "ftr", "FTHG": "fthg", "FTAG": "ftag",
}


def stream_parquet(spark: SparkSession, folder: str) -> DataFrame:
    out = scratch_folder(spark, "parquet")
    landed = jobs.landed(_messages(spark, folder))
    _finish(sinks.to_parquet(landed, out, scratch_folder(spark, "checkpoint"), once=True))
    return _flat(spark.read.schema(schema.MESSAGE).parquet(out))


def stream_docs(spark: SparkSession, folder: str) -> DataFrame:
    """JSON files stand in for the document store, whose connector is an external jar."""
    out = scratch_folder(spark, "documents")
    landed = jobs.landed(_messages(spark, folder))
    _finish(sinks.to_documents(landed, "json", {"path": out}, scratch_folder(spark, "checkpoint"), once=True))
    return _flat(spark.read.schema(schema.MESSAGE).json(out))


def _cut_messages(spark: SparkSession, folder: str) -> DataFrame:
    """The topic with every 37th text cut off behind its date."""
    messages = _messages(spark, folder)
    cut = F.when(F.col("offset") % 37 == 0, F.substring("value", 1, 20)).otherwise(F.col("value"))
    return messages.withColumn("value", cut)


def _good_and_bad(good: DataFrame, bad: DataFrame) -> DataFrame:
    """Records as ``_flat`` has them, and texts that are none, in one table."""
    rows = _flat(good).withColumn("raw", F.lit(None).cast("string"))
    return rows.unionByName(bad.select("raw"), allowMissingColumns=True)


def documents_once(spark: SparkSession, folder: str) -> DataFrame:
    """Every batch comes twice to a store without upsert, and two streams write to it; its documents, read back."""
    out, ledger = scratch_folder(spark, "documents"), scratch_folder(spark, "ledger")
    write = sinks.append_once("json", {"path": out}, ledger)

    def twice(batch: DataFrame, batch_id: int) -> None:
        for _ in range(2):
            write(batch, batch_id)

    landed = jobs.landed(_messages(spark, folder))
    for home in (True, False):
        part = landed.where((F.col("FTR") == "H") if home else (F.coalesce("FTR", F.lit("")) != "H"))
        _finish(sinks.for_each_batch(part, twice, scratch_folder(spark, "checkpoint"), once=True))
    return _flat(spark.read.schema(schema.MESSAGE).json(out))


def fanout(spark: SparkSession, folder: str) -> DataFrame:
    """One parse per batch for two sinks; every batch is written twice, as after a failure."""
    good, bad = scratch_folder(spark, "good"), scratch_folder(spark, "bad")
    write = jobs.landing_batches(sinks.replace_batch(good), sinks.replace_batch(bad))

    def twice(batch: DataFrame, batch_id: int) -> None:
        write(batch, batch_id)
        write(batch, batch_id)

    checkpoint = scratch_folder(spark, "checkpoint")
    _finish(sinks.for_each_batch(_cut_messages(spark, folder), twice, checkpoint, once=True))
    return _good_and_bad(spark.read.parquet(good), spark.read.parquet(bad))


def landing_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """The landing job with a folder for texts that are no record."""
    good, bad = scratch_folder(spark, "good"), scratch_folder(spark, "bad")
    checkpoint = scratch_folder(spark, "checkpoint")
    for query in jobs.landing_job(_cut_messages(spark, folder), good, checkpoint, once=True, quarantine=bad):
        _finish(query)
    return _good_and_bad(spark.read.schema(schema.MESSAGE).parquet(good), spark.read.schema("raw string").parquet(bad))


def restart(spark: SparkSession, folder: str) -> DataFrame:
    """The query stops after the even messages and goes on, from its checkpoint, with the odd ones."""
    topic, out, checkpoint = (scratch_folder(spark, name) for name in ("topic", "parquet", "checkpoint"))
    rows = matches(spark, folder)
    for odd in (0, 1):
        part = rows.where(F.col("match_id") % 2 == odd)
        _write_topic(part.select("match_id", "season", "fthg"), topic)
        source = _read_topic(spark, topic, "match_id bigint, season string, fthg int")
        _finish(sinks.to_parquet(source, out, checkpoint, once=True))
    return spark.read.parquet(out)


def stream_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every match is sent twice; copies within the delay are dropped."""
    topic, out = scratch_folder(spark, "topic"), scratch_folder(spark, "parquet")
    rows = matches(spark, folder).select("match_id", F.col("match_ts").cast("timestamp").alias("at"), "season")
    for sent in range(2):
        _write_topic(rows.withColumn("sent", F.lit(sent)), topic)
    source = _read_topic(spark, topic, "match_id bigint, at timestamp, season string, sent int")
    once = without_copies(source, ["match_id"], "at", "60 days", "sent")
    _finish(sinks.to_parquet(once, out, scratch_folder(spark, "checkpoint"), once=True))
    return spark.read.parquet(out).select("match_id", "season")


def _batches(spark: SparkSession, folder: str) -> tuple[str, DataFrame]:
    """Matches in folders that cut through all seasons, and the rows themselves."""
    source = scratch_folder(spark, "matches")
    rows = matches(spark, folder).withColumn("batch", F.pmod(F.xxhash64("match_id"), F.lit(BATCHES)))
    rows.write.partitionBy("batch").parquet(source)
    return source, rows.drop("batch")


def incremental_features(spark: SparkSession, folder: str) -> DataFrame:
    """Matches arrive in batches that cut through all seasons; the last features are right."""
    table, checkpoint = scratch_folder(spark, "table"), scratch_folder(spark, "checkpoint")
    source, rows = _batches(spark, folder)
    # one stream over all folders, one file a batch
    count = files.list_files(spark, source).where(F.col("path").endswith(".parquet")).count()
    part = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", max(1, -(-count // BATCHES)))
    _finish(sinks.for_each_batch(part.parquet(f"{source}/*"), incremental.upsert_and_recompute(table), checkpoint, once=True))
    return incremental.read(spark, table).drop("match_ts")


def incremental_new_run(spark: SparkSession, folder: str) -> DataFrame:
    """Each part comes by a stream with a new checkpoint, whose batches start at number 0 over the same table."""
    table = scratch_folder(spark, "table")
    source, rows = _batches(spark, folder)
    for number in range(BATCHES):
        part = spark.readStream.schema(rows.schema).parquet(f"{source}/batch={number}")
        write = incremental.upsert_and_recompute(table)
        _finish(sinks.for_each_batch(part, write, scratch_folder(spark, "checkpoint"), once=True))
    return incremental.read(spark, table).drop("match_ts")


def incremental_replayed(spark: SparkSession, folder: str) -> DataFrame:
    """Every batch fails once between its data and its commit, comes again, and again when all is done; the
    table is compacted on the way."""
    table = scratch_folder(spark, "table")
    write = incremental.upsert_and_recompute(table, run="replayed")
    source, rows = _batches(spark, folder)
    parts = [spark.read.schema(rows.schema).parquet(f"{source}/batch={number}") for number in range(BATCHES)]
    for number, part in enumerate(parts):
        log = read_log(spark, table)
        incremental.stage(part, table)(log, begin(log, "replayed", number))
        write(part, number)
        if number == 1:
            incremental.compact(spark, table)
            vacuum(spark, table, incremental.PARTS)
    for number, part in enumerate(parts):
        write(part, number)
    return incremental.read(spark, table).drop("match_ts")


def _after_correction(spark: SparkSession, folder: str, first: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """All matches as ``first`` has them, then those that it changed as they are: two batches."""
    table = scratch_folder(spark, "table")
    write = incremental.upsert_and_recompute(table)
    rows = matches(spark, folder)
    wrong = first(rows)
    write(wrong, 0)
    write(rows.exceptAll(wrong), 1)
    return incremental.read(spark, table).drop("match_ts")


def incremental_moved(spark: SparkSession, folder: str) -> DataFrame:
    """Matches that first came under another league, some of them without season or league."""
    league = F.when(F.col("match_id") % 5 == 0, F.lit("SP1")).when(F.col("match_id") % 7 != 0, F.col("league"))
    season = F.when(F.col("match_id") % 11 != 0, F.col("season"))
    return _after_correction(spark, folder, lambda rows: rows.withColumns({"league": league, "season": season}))


def incremental_withdrawn(spark: SparkSession, folder: str) -> DataFrame:
    """Results that are taken back, those of a league of their own among them."""
    gone = F.col("ftr").isNull()
    changes = {"ftr": F.coalesce("ftr", F.lit("H")), "league": F.when(gone, F.lit("X=1/2")).otherwise(F.col("league"))}
    return _after_correction(spark, folder, lambda rows: rows.withColumns(changes))


def features_strict_null_key(spark: SparkSession, folder: str) -> DataFrame:
    """The flagship with a key of which one column is always null."""
    rows = matches(spark, folder).withColumn("leg", F.lit(None).cast("string"))
    return strict.features(rows, key=["match_id", "leg"]).drop("match_ts", "leg")


def _state_store(spark: SparkSession) -> None:
    name = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(name, SETTINGS[name])


def _far(rows: DataFrame, number: int) -> DataFrame:
    """A row nine years after all others, which moves the watermark past them; it stays in the state itself."""
    far = {**{name: F.lit("end") for name in [*strict.GROUP, "side"]}, "match_id": F.lit(number), "points": F.lit(0)}
    end = rows.agg(F.expr("max(match_time) + INTERVAL 9 YEARS").alias("match_time"))
    return end.withColumns(far).select(*_FORM_COLUMNS)


def _form_topic(spark: SparkSession, rows: DataFrame, parts: list[DataFrame]) -> DataFrame:
    """A stream of team rows, the parts one after the other."""
    _state_store(spark)
    topic = scratch_folder(spark, "topic")
    for part in [*parts, _far(rows, -1)]:
        _write_topic(part.select(*_FORM_COLUMNS), topic)
    return _read_topic(spark, topic, _FORM_FIELDS)


_FORM_FIELDS = "season string, league string, team string, match_id bigint, side string, points int, match_time timestamp"
_FORM_COLUMNS = [*strict.GROUP, "match_id", "side", "points", "match_time"]


def _form_rows(spark: SparkSession, folder: str) -> DataFrame:
    teams = strict.team_rows(matches(spark, folder), values=("points",))
    return teams.withColumn("match_time", F.col("match_ts").cast("timestamp")).select(*_FORM_COLUMNS)


def stateful_last5(spark: SparkSession, folder: str) -> DataFrame:
    """Form from streaming state. Five days at a time are sent, unordered among themselves."""
    out, rows, day = scratch_folder(spark, "parquet"), _form_rows(spark, folder), F.dayofmonth("match_time")
    parts = [rows.where((day >= first) & (day < first + 5)) for first in range(1, 32, 5)]
    form = last_five(_form_topic(spark, rows, parts), "6 days")
    _finish(sinks.to_parquet(form, out, scratch_folder(spark, "checkpoint"), once=True))
    return spark.read.parquet(out).select("match_id", "side", "team", "form5")


def stateful_from_history(spark: SparkSession, folder: str) -> DataFrame:
    """The first day of each season comes from a batch job, which hands its teams over to a stream of the second."""
    out, rows = scratch_folder(spark, "parquet"), _form_rows(spark, folder)
    first, second = (rows.where(F.dayofmonth("match_time") % 2 == odd) for odd in (1, 0))
    stream = last_five(_form_topic(spark, rows, [second]), "40 days", tails(first))
    _finish(sinks.to_parquet(stream, out, scratch_folder(spark, "checkpoint"), once=True))
    form = F.sum("points").over(before(strict.GROUP, ["match_time", "match_id", "side"], 5))
    columns = ["match_id", "side", "team", "form5"]
    return first.withColumn("form5", form).select(*columns).union(spark.read.parquet(out).select(*columns))


def late_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The first day of each season comes when the form of the second is out: late for the teams that played on it.
    Both sinks together have every row; the matches of the late ones go to the incremental job, whose form is right."""
    _state_store(spark)
    form, late, table, topic, checkpoint = (
        scratch_folder(spark, name) for name in ("form", "late", "table", "topic", "checkpoint")
    )
    rows, day = _form_rows(spark, folder), F.dayofmonth("match_time")
    write = split_late(sinks.replace_batch(form), sinks.replace_batch(late))
    # the query ends after each part and goes on with the next
    for part in (rows.where(day % 2 == 0), _far(rows, -1), rows.where(day % 2 == 1), _far(rows, -2)):
        _write_topic(part, topic)
        source = form_and_late(stream(spark, "json", {"path": topic}, _FORM_FIELDS), "40 days")
        _finish(sinks.for_each_batch(source, write, checkpoint, once=True))
    behind = spark.read.parquet(late).where("match_id >= 0")
    sent = matches(spark, folder)
    upsert = incremental.upsert_and_recompute(table)
    for number, how in enumerate(("left_anti", "left_semi")):
        upsert(sent.join(behind.select("match_id"), "match_id", how), number)
    right = incremental.read(spark, table).select("match_id", F.col("home_form5_any").alias("home_form"))
    columns = ["match_id", "side", "team"]
    emitted = spark.read.parquet(form).where("match_id >= 0").select(*columns, F.lit(False).alias("late"))
    return emitted.union(behind.select(*columns, F.lit(True))).join(right, "match_id", "left")


def carried_last5(spark: SparkSession, folder: str) -> DataFrame:
    """Form from batches in time order, with each team's last rows carried from batch to batch."""
    out, tails = scratch_folder(spark, "form"), scratch_folder(spark, "tails")
    step = form_with_carry(tails, sinks.replace_batch(out))
    rows = matches(spark, folder)
    for number, first in enumerate(range(1, 32, 8)):
        day = F.dayofmonth("match_ts")
        step(rows.where((day >= first) & (day < first + 8)), number)
    return spark.read.parquet(out).select("match_id", "side", "team", *FORM)


def _results(rows: DataFrame) -> DataFrame:
    """What each team got out of each match; null for a match without a result."""
    teams = strict.team_rows(rows, key=["match_id", "ftr"], time=[], values=BEFORE)
    return teams.withColumns({name: F.when(F.col("ftr").isNotNull(), F.col(name)) for name in BEFORE}).drop("ftr")


BEFORE = ("points", "goals", "conceded")


def carried_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Points and goals up to the day before, from sums that batches in no order of time change: the first ones hold
    wrong results and matches not played, the last one what is right; one comes twice."""
    table, rows = scratch_folder(spark, "totals"), matches(spark, folder)
    write = add_up(table, ["match_id", "side"], strict.GROUP, strict.DAY, list(BEFORE))
    wrong = rows.withColumns({
        "ftr": F.when(F.col("match_id") % 7 == 0, F.lit("A")).otherwise(F.coalesce("ftr", F.lit("D"))),
        "fthg": F.when(F.col("match_id") % 7 == 0, F.col("fthg") + 2).otherwise(F.col("fthg")),
        "match_date": F.when(F.col("match_id") % 7 == 0, F.date_add("match_date", -40)).otherwise(F.col("match_date")),
    })
    for number in range(BATCHES):
        write(_results(wrong.where(F.pmod(F.xxhash64("match_id"), F.lit(BATCHES)) == number)), number)
    right = rows.where((F.col("match_id") % 7 == 0) | F.col("ftr").isNull())
    for number in (BATCHES, 1, BATCHES):
        write(_results(right), number)
    asked = strict.team_rows(rows.where("ftr IS NOT NULL"), time=[], values=())
    before = {f"{name}_before": name for name in BEFORE}
    found = totals_before(spark, table, asked, strict.GROUP, strict.DAY, before, {"season_points": "points"})
    return found.select("match_id", "side", "team", *before, "season_points")


FORM = ["form5_any", "form5_venue", "goals5_venue", "discipline5_venue"]
TIE = ["match_ts", "match_id"]


def _feature_stream(spark: SparkSession, folder: str, start: Callable[..., StreamingQuery]) -> DataFrame:
    """A feature job over the whole topic as one micro-batch, written to two sinks."""
    topic, out, docs = (scratch_folder(spark, name) for name in ("topic", "parquet", "documents"))
    to_messages(records(spark, folder), TIE).write.parquet(topic)
    source = stream(spark, "parquet", {"path": topic}, "match_ts timestamp_ntz, match_id bigint, value string")
    writes = [sinks.replace_batch(out), sinks.append_documents("json", {"path": docs})]
    _finish(start(source, TIE, scratch_folder(spark, "checkpoint"), *writes, once=True))
    rows = spark.read.parquet(out).drop("run", "batch_id")
    return rows.withColumnsRenamed({name: "away_shots" if name == "AS" else name.lower() for name in rows.columns})


def stream_features_a(spark: SparkSession, folder: str) -> DataFrame:
    return _feature_stream(spark, folder, jobs.feature_job_a)


def stream_features_b(spark: SparkSession, folder: str) -> DataFrame:
    return _feature_stream(spark, folder, jobs.feature_job_b)


FILE_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in [
        csv_scan, csv_union_by_name, csv_quarantine, file_gate, publish_run, bronze_raw, stream_parquet, stream_docs,
        documents_once, fanout, landing_quarantine, restart,
        stream_dedup, incremental_features, incremental_new_run, incremental_replayed, incremental_moved,
        incremental_withdrawn, features_strict_null_key, stateful_last5, stateful_from_history, late_rows, carried_last5,
        carried_totals,
        stream_features_a, stream_features_b,
    ]
}

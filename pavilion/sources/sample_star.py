"""A cricket-shaped star derived from the sample tables, and match documents made from it.

The sample tables have no matches in them, so line items play the balls: fifty order keys
make a match, the rest of a line number its innings: two, or four where a match is a test. Built once per session and input,
then read from files, as reports read stored tables.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from pavilion.operators.ordinals import row_numbers
from pavilion.plans.star import SQUAD_MATCH_COLUMNS, Star, build_star, date_dim, with_extras
from pavilion.session import materialize, shared_dir
from pavilion.sources.match_json import stage

TEAMS, SQUAD = 8, 11

_built = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        F.expr("l_orderkey div 50").alias("match_id"),
        F.expr("cast(1 + l_linenumber % if((l_orderkey div 50) % 3 = 2, 4, 2) as int)").alias("innings"),
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate",
        "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
    )
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"]
    balls = row_numbers(li, ["match_id", "innings"], order, "seq")
    t1 = F.expr("match_id % 8 + 1")
    t2 = F.expr("(match_id % 8 + 1 + (match_id div 8) % 7) % 8 + 1")
    tax, status = F.col("l_tax"), F.col("l_linestatus")
    balls = balls.select(
        "*",
        F.when(F.col("innings") % 2 == 1, t1).otherwise(t2).alias("bt"),
        F.when(F.col("innings") % 2 == 1, t2).otherwise(t1).alias("wt"),
        F.expr("1 + (seq - 1) div 6").alias("overs"),
        F.expr("1 + (seq - 1) % 6").alias("balls"),
        F.when(tax == 0.08, 1).alias("wides"),
        F.when((tax == 0.07) & (status == "O"), 1).alias("no_balls"),
        F.when((tax == 0.06) & (status == "F"), 1).alias("byes"),
        F.when((tax == 0.05) & (status == "F"), 1).alias("leg_byes"),
        (F.col("l_quantity").cast("int") % 7).alias("batter_runs"),
    )
    batter = F.expr("bt * 11 + l_partkey % 5")
    kind = F.expr("""case when l_discount > 0.01 then null
        when l_returnflag = 'A' then if(l_suppkey % 4 = 0, 'stumped', 'caught')
        when l_returnflag = 'N' then case l_partkey % 5 when 0 then 'lbw' when 1 then 'hit wicket' else 'bowled' end
        when l_linestatus = 'F' then case l_partkey % 7 when 0 then 'obstructing the field' when 1 then 'retired hurt' else 'run out' end
        else 'caught and bowled' end""")
    fielded = kind.isin("caught", "stumped", "run out")
    extras = [F.coalesce(c, F.lit(0)) for c in ("wides", "no_balls", "byes", "leg_byes")]
    return balls.select(
        "match_id",
        F.date_add(F.lit("1995-01-01").cast("date"), (F.col("match_id") * 3).cast("int")).alias("match_date"),
        F.col("bt").alias("batting_team_id"),
        F.col("wt").alias("bowling_team_id"),
        "innings", "overs", "balls",
        batter.alias("batter_id"),
        F.expr("bt * 11 + (l_partkey + 1) % 5").alias("non_striker_id"),
        F.expr("wt * 11 + 5 + overs % 6").alias("bowler_id"),
        "byes", "leg_byes", "no_balls", "wides", "batter_runs",
        (F.col("batter_runs") + extras[0] + extras[1] + extras[2] + extras[3]).alias("total_runs"),
        kind.alias("wicket_kind"),
        F.when(kind.isNotNull(), batter).alias("player_out_id"),
        F.when(fielded, F.expr("wt * 11 + l_suppkey % 11")).alias("fielder_id"),
    )


def matches(balls: DataFrame) -> DataFrame:
    first, second = F.col("innings") % 2 == 1, F.col("innings") % 2 == 0
    sums = balls.groupBy("match_id").agg(
        F.any_value("match_date").alias("match_date"),
        F.max(F.when(first, F.col("batting_team_id"))).alias("t1"),
        F.max(F.when(second, F.col("batting_team_id"))).alias("t2"),
        F.sum(F.when(first, F.col("total_runs")).otherwise(0)).alias("r1"),
        F.sum(F.when(second, F.col("total_runs")).otherwise(0)).alias("r2"),
        F.min(F.when(F.col("batter_runs") == 6, F.col("batter_id"))).alias("player_of_match_id"),
    )
    return sums.selectExpr(
        "match_id",
        "match_date",
        "cast(year(match_date) as string) as season",
        "'Event_' || (match_id % 5) as event_name",
        "'Venue_' || (match_id % 11) as venue",
        "case match_id % 3 when 0 then 'T20' when 1 then 'ODI' else 'Test' end as match_type",
        "case when match_id % 17 = 0 then 'no result' when match_id % 13 = 0 then 'tie' end as match_result",
        """case when match_id % 17 = 0 then null when match_id % 13 = 0 then t2
                when r1 >= r2 then t1 else t2 end as match_winner_id""",
        """case when match_id % 17 <> 0 and match_id % 13 <> 0 and r1 >= r2
                then cast(r1 - r2 as string) end as match_won_by_runs""",
        """case when match_id % 17 <> 0 and match_id % 13 <> 0 and r1 < r2
                then cast(1 + match_id % 9 as string) end as match_won_by_wickets""",
        "case when match_id % 19 = 0 then '1' end as match_won_by_innings",
        "case when match_id % 7 = 0 then 'D/L' end as match_result_method",
        "case when match_id % 2 = 0 then t1 else t2 end as toss_winner_id",
        "case when match_id % 2 = 0 then 'bat' else 'field' end as toss_decision",
        "t1 as first_bat_id",
        "t2 as first_field_id",
        "player_of_match_id",
    )


def team_players(match_rows: DataFrame) -> DataFrame:
    sides = match_rows.withColumn("team_id", F.explode(F.array("first_bat_id", "first_field_id")))
    squad = sides.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(SQUAD - 1))))
    return squad.select(
        "match_id", "team_id", (F.col("team_id") * SQUAD + F.col("i")).alias("player_id"), *SQUAD_MATCH_COLUMNS
    )


def name_dims(spark: SparkSession):
    """The fixed squads: eight teams of eleven."""
    teams = spark.range(1, TEAMS + 1).select(F.col("id").alias("team_id"), F.expr("'Team_' || id").alias("team"))
    players = spark.range(SQUAD, (TEAMS + 1) * SQUAD)
    players = players.select(F.col("id").alias("player_id"), F.expr("'Player_' || id").alias("player_name"))
    return materialize(teams, "t_dim_team"), materialize(with_extras(players), "t_dim_player")


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as job rows: the first event of a user and day is the parent of the others."""
    ev = table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", "event_type", "value",
        F.struct("user_id", F.to_date("ts").alias("day")).alias("user_day"),
    )
    heads = ev.groupBy("user_day").agg(F.min_by("event_id", F.struct("ts", "event_id")).alias("head"))
    job, head = F.col("event_id").cast("string"), F.col("head").cast("string")
    seconds = F.make_dt_interval(secs=F.floor(F.col("value") * 1000).cast("decimal(18,6)"))
    return ev.join(heads, "user_day", "left").select(
        job.alias("job_id"),
        F.nullif(head, job).alias("parent_job_id"),
        F.concat("event_type", F.lit("_"), "user_id").alias("job_name"),
        F.col("event_type").alias("job_category"),
        F.col("ts").alias("start_time"),
        F.when(F.col("event_type") != "error", F.col("ts") + seconds).alias("end_time"),
        F.when(F.col("event_type") == "error", "Failed")
        .when(F.col("event_type") == "signup", "InProgress")
        .otherwise("Completed")
        .alias("status"),
        F.lit(None).cast("string").alias("message"),
    )


def _version(spark: SparkSession, sf_dir: str):
    """Size and time of the files the star is made from, so changed input is built anew."""
    def stamp(name):
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{name}.parquet")
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        return fs.getContentSummary(path).getLength(), fs.getFileStatus(path).getModificationTime()

    return spark.sparkContext.applicationId, str(sf_dir), stamp("lineitem"), stamp("events")


def _once(spark, sf_dir, what, build):
    key = (what, *_version(spark, sf_dir))
    if key not in _built:
        _built[key] = build()
    return _built[key]


def sample_star(spark: SparkSession, sf_dir: str) -> Star:
    def build():
        teams, players = name_dims(spark)
        balls = materialize(deliveries(spark, sf_dir), "t_fact_deliveries")
        match_rows = materialize(matches(balls), "t_dim_match")
        squads = materialize(team_players(match_rows), "t_fact_team_players")
        dates = materialize(date_dim(match_rows), "t_dim_date")
        return Star(match_rows, teams, players, dates, squads, balls)

    return _once(spark, sf_dir, "star", build)


def sample_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _once(spark, sf_dir, "jobs", lambda: materialize(jobs(spark, sf_dir), "t_job"))


def documents(star: Star) -> DataFrame:
    """Match documents (match_id, info, innings, file_name), one a match, with the star's rows as nested JSON.

    Two-team squads, names in place of ids; the file key is the match's id.
    """
    def name(prefix, column):
        return F.concat(F.lit(prefix), F.col(column).cast("string"))

    def person(column):
        return name("Player_", column)

    wicket = F.struct(
        F.col("wicket_kind").alias("kind"),
        person("player_out_id").alias("player_out"),
        F.when(F.col("fielder_id").isNotNull(), F.array(F.struct(person("fielder_id").alias("name")))).alias("fielders"),
    )
    ball = F.struct(
        person("batter_id").alias("batter"),
        person("bowler_id").alias("bowler"),
        person("non_striker_id").alias("non_striker"),
        F.struct(F.col("batter_runs").alias("batter"), F.col("total_runs").alias("total")).alias("runs"),
        F.struct("byes", F.col("leg_byes").alias("legbyes"), F.col("no_balls").alias("noballs"), "wides").alias("extras"),
        F.when(F.col("wicket_kind").isNotNull(), F.array(wicket)).alias("wickets"),
    )

    def listed(df, keys, order, value, out):
        rows = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), value.alias("v"))))
        return df.groupBy(*keys).agg(F.transform(rows, lambda r: r["v"]).alias(out))

    # Dealt out once, by match and as narrow rows; whatever is listed below stays where its match is.
    balls = star.deliveries.repartition("match_id").withColumn("team", name("Team_", "batting_team_id"))
    keys = ["match_id", "innings", "team"]
    overs = listed(balls, [*keys, "overs"], "balls", ball, "deliveries")
    innings = listed(overs, keys, "overs", F.struct("deliveries"), "overs")
    docs = listed(innings, ["match_id"], "innings", F.struct("team", "overs"), "innings")

    def squad(team):
        ids = F.sequence(F.lit(0), F.lit(SQUAD - 1))
        return F.transform(ids, lambda i: F.concat(F.lit("Player_"), (F.col(team) * SQUAD + i).cast("string")))

    info = F.struct(
        F.array(F.col("match_date").cast("string")).alias("dates"),
        F.expr("if(match_id % 4 = 1, 'female', 'male')").alias("gender"),
        "season",
        F.struct(
            F.col("event_name").alias("name"),
            F.expr("if(match_id % 6 = 2, 'Group ' || match_id % 2, null)").alias("group"),
            (F.col("match_id") % 100).alias("match_number"),
        ).alias("event"),
        F.expr("if(match_id % 5 = 3, null, 'City_' || match_id % 11)").alias("city"),
        "venue",
        F.expr("if(match_id % 3 = 0, 'club', 'international')").alias("team_type"),
        "match_type",
        F.struct(F.array(F.lit("U1"), name("U_", "season")).alias("umpires")).alias("officials"),
        F.struct(
            F.when(F.col("match_result").isNull(), name("Team_", "match_winner_id")).alias("winner"),
            F.col("match_result").alias("result"),
            F.when(F.col("match_result") == "tie", name("Team_", "match_winner_id")).alias("eliminator"),
            F.col("match_result_method").alias("method"),
            F.struct(
                F.col("match_won_by_runs").cast("int").alias("runs"),
                F.col("match_won_by_wickets").cast("int").alias("wickets"),
                F.col("match_won_by_innings").cast("int").alias("innings"),
            ).alias("by"),
        ).alias("outcome"),
        F.struct(name("Team_", "toss_winner_id").alias("winner"), F.col("toss_decision").alias("decision")).alias("toss"),
        F.when(F.col("player_of_match_id").isNotNull(), F.array(person("player_of_match_id"))).alias("player_of_match"),
        F.map_from_arrays(
            F.array(name("Team_", "first_bat_id"), name("Team_", "first_field_id")),
            F.array(squad("first_bat_id"), squad("first_field_id")),
        ).alias("players"),
    )
    return docs.join(star.matches, "match_id").select(
        "match_id",
        F.to_json(info).alias("info"),
        F.to_json("innings").alias("innings"),
        F.concat(F.col("match_id").cast("string"), F.lit(".json")).alias("file_name"),
    )


# Files beside the sample's that are no match documents.
ODD_FILES = {"900001.json": '{"info": {"season": "1995"}, "innings": [', "900002.json": '{"info": {}}', "notes.json": '{"info": {}, "innings": []}'}


def write_files(texts: DataFrame, folder: str) -> None:
    """A file per row of (file_name, content), which ends with a line break. Tasks write them under their names; one that runs again
    writes the same files again. Where only Spark reaches the store, its writer makes a folder a file, whose file then moves up.
    """
    spark = texts.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path
    home = path(folder)
    fs = home.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(home)
    named = texts.filter("file_name is not null").select("file_name", "content")
    if fs.getScheme() == "file":
        local = home.toUri().getPath()

        def write(rows):
            for row in rows:
                with open(f"{local}/{row.file_name}", "w", encoding="utf-8", newline="") as file:
                    file.write(f"{row.content or ''}\n")

        return named.foreachPartition(write)
    # Tasks move what they wrote by themselves, not the driver after them.
    moved = {"mapreduce.fileoutputcommitter.algorithm.version": "2"}
    named.repartition("file_name").write.options(**moved).partitionBy("file_name").text(f"{folder}-parts")
    for part in fs.globStatus(path(f"{folder}-parts/file_name=*/part-*")):
        name = part.getPath().getParent().getName().split("=", 1)[1]
        fs.rename(part.getPath(), path(f"{folder}/{name}"))


def document_folder(spark: SparkSession, sf_dir: str) -> str:
    """A folder of the sample's match documents, over several lines each, and of files that are none."""
    def build():
        folder = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/files-{uuid.uuid4().hex[:12]}"
        parts = documents(sample_star(spark, sf_dir))
        content = F.concat(F.lit('{\n "info": '), "info", F.lit(',\n "innings": '), "innings", F.lit("\n}"))
        odd = spark.createDataFrame(list(ODD_FILES.items()), "file_name string, content string")
        write_files(parts.select("file_name", content.alias("content")).union(odd), folder)
        return folder

    return _once(spark, sf_dir, "files", build)


def document_star(spark: SparkSession, sf_dir: str):
    """(staging, star) with the star built from the JSON documents rather than from line items."""
    def build():
        staging = materialize(stage(documents(sample_star(spark, sf_dir))), "t_staged_match")
        return staging, build_star(staging)

    return _once(spark, sf_dir, "documents", build)

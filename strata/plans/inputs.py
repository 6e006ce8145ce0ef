"""The operators' logical inputs, derived from the driver tables.

Every input exists twice: as a DataFrame and, for the checking SQL, as a common
table expression of the same name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.columns import referrer_rules

# Bands of a member's yearly spending.
MEMBER_BANDS = [(660_000, "star"), (420_000, "good"), (235_000, "average")]
# Rating bands of the yearly mean (strictly above).
RATING_BANDS = [(8, "star"), (7, "good"), (6, "average")]
LOWEST = "bad"
FIRST_SEASON, LAST_SEASON = 1995, 2001
# The day the daily jobs run for, and the day before it.
DS, DS_BEFORE = "2024-01-30", "2024-01-29"

HOSTS = ["www.alpha.example", "app.alpha.example", "shop.beta.example"]
REFERRERS = [
    "https://www.linkedin.com/feed", "https://t.co/abc", "https://www.google.com/search", "https://lnkd.in/x",
    "https://www.reddit.com/r/data", "https://alpha.example/home",
]
OWN_SITES = ["alpha.example"]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def member_seasons(spark: SparkSession, sf: str) -> DataFrame:
    """Yearly spending per customer: (member_id, season, gp, pts, segment, nation)."""
    orders = table(spark, sf, "orders").groupBy(
        F.col("o_custkey").alias("member_id"), F.year("o_orderdate").alias("season")).agg(
        F.count(F.lit(1)).alias("gp"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("pts"))
    customer = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("member_id"), F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation"))
    return orders.join(customer, "member_id")


MEMBER_SEASONS = """ms as (
  select o.o_custkey as member_id, cast(year(o.o_orderdate) as integer) as season, count(*) as gp,
         sum(cast(o.o_totalprice as decimal(18,2))) as pts, any_value(c.c_mktsegment) as segment, any_value(c.c_nationkey) as nation
  from orders o join customer c on c.c_custkey = o.o_custkey group by 1, 2)"""


def sql_band(value: str, bands, default: str) -> str:
    whens = " ".join(f"when {value} > {t} then '{n}'" for t, n in bands)
    return f"case {whens} else '{default}' end"


# The referrer rules as SQL, from the list that the library's rules come from.
SQL_REFERRER = "case " + " ".join(f"when contains(referrer, '{part}') then '{name}'" for part, name in referrer_rules(OWN_SITES)) + " else referrer end"


def sql_part(value: str, parts: int) -> str:
    """The part that a value belongs to in lists of ``parts`` rows."""
    return f"cast(('0x' || substr(md5(coalesce(cast({value} as varchar), '')), 1, 4))::bigint % {parts} as bigint)"


# Snapshots of every member and season by an inequality join.
SNAPSHOTS = MEMBER_SEASONS + f""",
spine as (select member_id, unnest(range(min(season), {LAST_SEASON + 1})) as season from ms group by member_id),
snap as (
  select s.member_id, cast(s.season as integer) as season, any_value(m.segment) as segment, any_value(m.nation) as nation,
         string_agg(m.season || ':' || m.gp || ':' || m.pts, ',' order by m.season) as history,
         {sql_band("arg_max(m.pts, m.season)", MEMBER_BANDS, LOWEST)} as entity_class,
         max(m.season) = s.season as is_active,
         cast(s.season - max(m.season) as integer) as periods_since_active
  from spine s join ms m on m.member_id = s.member_id and m.season <= s.season
  group by s.member_id, s.season)"""


def films(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as an actor's films: (actor_id, film_id, year, votes, rating)."""
    return table(spark, sf, "orders").select(
        F.col("o_custkey").alias("actor_id"), F.col("o_orderkey").alias("film_id"), F.year("o_orderdate").alias("year"),
        F.length("o_orderpriority").alias("votes"), F.pmod("o_orderkey", F.lit(10)).alias("rating"))


FILMS = """films as (
  select o_custkey as actor_id, o_orderkey as film_id, cast(year(o_orderdate) as integer) as year,
         length(o_orderpriority) as votes, o_orderkey % 10 as rating from orders)"""


def game_details(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines as box scores: a supplier plays for its nation in an order."""
    player = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("player_id"), F.col("s_name").alias("player_name"), F.col("s_nationkey").alias("team_id"))
    team = table(spark, sf, "nation").select(F.col("n_nationkey").alias("team_id"), F.col("n_name").alias("team_name"))
    line = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("game_id"), F.col("l_suppkey").alias("player_id"), "l_linenumber", "l_partkey",
        F.col("l_quantity").cast("bigint").alias("pts"))
    return line.join(player, "player_id").join(team, "team_id")


GAME_ORDER = ["l_linenumber", "l_partkey", "pts"]

GAME_DETAILS = """gd as (
  select l.l_orderkey as game_id, l.l_suppkey as player_id, s.s_name as player_name, s.s_nationkey as team_id, n.n_name as team_name,
         cast(l.l_quantity as bigint) as pts, l.l_linenumber, l.l_partkey
  from lineitem l join supplier s on s.s_suppkey = l.l_suppkey join nation n on n.n_nationkey = s.s_nationkey),
played as (
  select * from (select *, row_number() over (partition by player_id, game_id order by l_linenumber, l_partkey, pts) as rn from gd)
  where rn = 1)"""


def games(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as games: (game_id, game_date, season, won)."""
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("game_id"), F.to_date("o_orderdate").alias("game_date"),
        F.year("o_orderdate").alias("season"), (F.col("o_orderstatus") == "F").alias("won"))


GAMES = """games as (
  select o_orderkey as game_id, cast(o_orderdate as date) as game_date, cast(year(o_orderdate) as integer) as season,
         o_orderstatus = 'F' as won from orders)"""


def team_games(spark: SparkSession, sf: str) -> DataFrame:
    """One row per nation and order: (team, game_id, game_date, win)."""
    customer = table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("team"))
    return table(spark, sf, "orders").join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "team", F.col("o_orderkey").alias("game_id"), F.to_date("o_orderdate").alias("game_date"),
        (F.col("o_orderstatus") == "F").cast("int").alias("win"))


TEAM_GAMES = """tg as (
  select c_nationkey as team, o_orderkey as game_id, cast(o_orderdate as date) as game_date,
         case when o_orderstatus = 'F' then 1 else 0 end as win
  from orders join customer on c_custkey = o_custkey)"""


def web_events(spark: SparkSession, sf: str) -> DataFrame:
    """Events as page views: (event_id, event_time, user_id, device_id, url, host, referrer, value)."""
    return web_columns(table(spark, sf, "events"))


def web_columns(events: DataFrame) -> DataFrame:
    def pick(n, values):
        which = F.when(n == 0, F.lit(values[0]))
        for i, v in enumerate(values[1:], 1):
            which = which.when(n == i, F.lit(v))
        return which

    return events.select(
        "event_id", F.col("ts").alias("event_time"), "user_id",
        F.get_json_object("props", "$.k").cast("bigint").alias("device_id"),
        F.concat(F.lit("/"), F.col("event_type")).alias("url"),
        pick(F.pmod("user_id", F.lit(3)), HOSTS).alias("host"),
        pick(F.pmod("event_id", F.lit(7)), REFERRERS).alias("referrer"),
        "value")


def _sql_pick(n: str, values) -> str:
    return "case " + n + " " + " ".join(f"when {i} then '{v}'" for i, v in enumerate(values)) + " end"


WEB = f"""web as (
  select event_id, ts as event_time, user_id, cast(regexp_extract(props, '[0-9]+') as bigint) as device_id,
         '/' || event_type as url, {_sql_pick("user_id % 3", HOSTS)} as host, {_sql_pick("event_id % 7", REFERRERS)} as referrer, value
  from events)"""


def devices(spark: SparkSession, sf: str) -> DataFrame:
    """Parts as devices: (device_id, browser_type, device_type, os_type); some types are unknown (null)."""
    size = F.pmod("p_size", F.lit(4))
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("device_id"),
        F.when(F.col("p_size") < 45, F.col("p_brand")).alias("browser_type"),
        F.col("p_type").alias("device_type"),
        F.when(size > 0, F.concat(F.lit("os-"), size.cast("string"))).alias("os_type"))


DEVICES = """devices as (
  select p_partkey as device_id, case when p_size < 45 then p_brand end as browser_type, p_type as device_type,
         case when p_size % 4 > 0 then 'os-' || (p_size % 4) end as os_type from part)"""


def matches(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as matches: (match_id, playlist_id, map_id, completion_date)."""
    customer = table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("map_id"))
    return table(spark, sf, "orders").join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("match_id"), F.col("o_orderpriority").alias("playlist_id"), "map_id",
        F.to_date("o_orderdate").alias("completion_date"))


MATCHES = """matches as (
  select o_orderkey as match_id, o_orderpriority as playlist_id, c_nationkey as map_id, cast(o_orderdate as date) as completion_date
  from orders join customer on c_custkey = o_custkey)"""


def match_details(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines as player performances: (match_id, player_id, line, kills, deaths)."""
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("match_id"), F.col("l_suppkey").alias("player_id"), F.col("l_linenumber").alias("line"),
        F.col("l_quantity").cast("bigint").alias("kills"), F.pmod("l_partkey", F.lit(20)).alias("deaths"))


MATCH_DETAILS = """match_details as (
  select l_orderkey as match_id, l_suppkey as player_id, l_linenumber as line, cast(l_quantity as bigint) as kills,
         l_partkey % 20 as deaths from lineitem)"""


def medals(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(F.col("p_partkey").alias("medal_id"), F.col("p_type").alias("medal_name"))


def medals_players(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("match_id"), F.col("l_suppkey").alias("player_id"), F.col("l_partkey").alias("medal_id"),
        F.col("l_linenumber").cast("bigint").alias("medal_count"))


def maps(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "nation").select(F.col("n_nationkey").alias("map_id"), F.col("n_name").alias("map_name"))


# Address ranges: one narrow range per nation inside wide ones per region, with gaps.
NATION_STEP, NATION_WIDTH = 171_798_691, 150_000_000
REGION_STEP, REGION_WIDTH = 858_993_459, 800_000_000
# The ranges are wide: 256 prefixes hold a handful of segments each.
GEO_PREFIX_BITS = 8


def geo_ranges(spark: SparkSession, sf: str) -> DataFrame:
    nation = table(spark, sf, "nation").select(
        (F.col("n_nationkey").cast("bigint") * NATION_STEP).alias("lo"),
        (F.col("n_nationkey").cast("bigint") * NATION_STEP + NATION_WIDTH - 1).alias("hi"),
        F.col("n_name").alias("country"), F.concat(F.lit("state-"), F.col("n_regionkey").cast("string")).alias("state"),
        F.concat(F.lit("city-"), F.col("n_nationkey").cast("string")).alias("city"))
    region = table(spark, sf, "region").select(
        (F.col("r_regionkey").cast("bigint") * REGION_STEP).alias("lo"),
        (F.col("r_regionkey").cast("bigint") * REGION_STEP + REGION_WIDTH - 1).alias("hi"),
        F.col("r_name").alias("country"), F.lit("").alias("state"), F.lit("").alias("city"))
    return nation.unionByName(region)


GEO = f"""ranges as (
  select cast(n_nationkey as bigint) * {NATION_STEP} as lo, cast(n_nationkey as bigint) * {NATION_STEP} + {NATION_WIDTH - 1} as hi,
         n_name as country, 'state-' || n_regionkey as state, 'city-' || n_nationkey as city from nation
  union all
  select cast(r_regionkey as bigint) * {REGION_STEP}, cast(r_regionkey as bigint) * {REGION_STEP} + {REGION_WIDTH - 1}, r_name, '', '' from region)"""

# A made-up but reproducible address for every event.
IP_FACTOR, IP_SPACE = 2_654_435_761, 4_294_967_296


def web_with_ip(events: DataFrame) -> DataFrame:
    """Page views with a dotted address derived from the event id."""
    from strata.functions.columns import number_ip

    number = F.pmod(F.col("event_id") * F.lit(IP_FACTOR), F.lit(IP_SPACE))
    return web_columns(events).withColumn("ip", number_ip(number))


IP_SQL = f"((event_id * {IP_FACTOR}) % {IP_SPACE})"
DOTTED_SQL = f"(({IP_SQL} >> 24) & 255) || '.' || (({IP_SQL} >> 16) & 255) || '.' || (({IP_SQL} >> 8) & 255) || '.' || ({IP_SQL} & 255)"

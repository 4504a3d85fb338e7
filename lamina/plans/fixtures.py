"""Film-shaped raw tables derived from the driver's ``part`` table.

The catalogue job reads four related CSV files that are not available here;
these four relations have the same contracts and exercise every branch of the
cleaning rules (padding, empty and impossible dates, NULL parts, zero and
missing amounts, text amounts and durations, unmatched join keys, planted
duplicates). Every row of ``part`` is used: films the dimension tables should
not match get a key no film has (negative), instead of being filtered out.

The SQL is plain enough to run unchanged in Spark and DuckDB, so the oracle
reads exactly the same input rows. ``{part}`` is the part relation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Offset of the planted second copy of every part (fits an INT id).
COPY_OFFSET = 1_000_000_000

BASE = f"""
select p_partkey as id, p_partkey as k, p_name as title0, p_name, p_type, p_brand, p_size
from {{part}}
union all
select p_partkey + {COPY_OFFSET}, p_partkey,
       case when p_partkey % 50 = 3 then p_name else concat(p_name, ' II') end,
       p_name, p_type, p_brand, p_size
from {{part}}
"""

RAW_SQL = {
    "movies": """
select cast(id as int) as id,
  concat('  ', title0, ' ') as title,
  case when k % 29 = 0 then null
       when k % 17 = 3 then concat(p_type, ' ,, ', replace(p_name, ' ', '  , , '), ' , ')
       else concat(p_type, ' ,', replace(p_name, ' ', '  , ')) end as genres,
  concat(upper(p_brand), ' ') as language,
  case when k % 31 = 0 then null else cast(p_size % 10 as double) + 0.5 end as user_score,
  case when k % 37 = 0 then null else cast(p_size % 4 as int) end as runtime_hour,
  cast(k % 60 as int) as runtime_min,
  case when k % 7 = 0 then ''
       when k % 7 = 1 then concat(cast(1950 + k % 50 as string), '/01/01')
       when k % 53 = 2 then concat(cast(1950 + k % 50 as string), '-02-30')
       else concat(cast(1950 + k % 50 as string), '-0', cast(1 + p_size % 9 as string), '-15') end
    as release_date,
  case when k % 41 = 0 then null else cast(p_size * 40 as int) end as vote_count
from base
""",
    "film_details": """
select cast(id as int) as id,
  case when k % 11 = 0 then null
       when k % 97 = 1 then concat('Solo ', cast(id as string))
       else concat(' ', p_brand) end as director,
  concat(p_brand, ' , ', p_type) as top_billed,
  case k % 4 when 0 then null when 1 then 0 else cast(p_size * 1000000 as bigint) end as budget_usd,
  case k % 5 when 0 then null when 1 then 0 else cast(k * 12345 as bigint) end as revenue_usd
from base
""",
    "more_info": """
select cast(id + 7 as int) as id,
  case when k % 13 = 0 then concat(cast(k % 60 as string), ' min')
       when k % 17 = 0 then concat(cast(p_size % 4 as string), 'h ', cast(k % 60 + 1 as string), ' min')
       else concat(cast(p_size % 4 as string), 'h ', cast(k % 60 as string), ' min') end as runtime,
  case when k % 8 = 0 then '' else concat('$', cast(p_size as string), ',000,000') end as budget,
  case when k % 10 = 0 then 'unknown' else concat('$', cast(k as string), ',500') end as revenue,
  case when k % 19 = 0 then cast(-id - 1 as int) else cast(id as int) end as film_id
from base
""",
    "poster_path": """
select case when id % 23 = 0 then cast(-id - 1 as int) else cast(id as int) end as id,
  concat('http://img.example/', cast(id as string)) as poster_path,
  concat('http://img.example/b/', cast(id as string)) as backdrop_path
from base
""",
}


# A second reading of some films that lost their id: the silver job must drop it
# (the bronze gate refuses such a file, so only the unpublished queries use it).
MOVIES_WITH_NULL_IDS = f"""
select * from ({RAW_SQL['movies']}) m
union all
select cast(null as int), concat(title, ' III'), genres, language, user_score, runtime_hour, runtime_min,
  release_date, vote_count
from ({RAW_SQL['movies']}) m where id % 43 = 5
"""


def movies_with_null_ids(spark: SparkSession, part: DataFrame) -> DataFrame:
    return spark.sql(f"with base as ({BASE.format(part='{part}')})\n{MOVIES_WITH_NULL_IDS}", part=part)


def raw_sql(name: str, part: str = "part") -> str:
    """Self-contained SQL for raw table ``name`` over relation ``part``."""
    return f"with base as ({BASE.format(part=part)})\n{RAW_SQL[name]}"


def raw_tables(spark: SparkSession, part: DataFrame) -> dict[str, DataFrame]:
    """The four raw film relations (lazy) over the given ``part`` DataFrame."""
    return {name: spark.sql(raw_sql(name, "{part}"), part=part) for name in RAW_SQL}

"""Independent DuckDB SQL for every registered query (the correctness oracle).

Written from the operator semantics, not generated from the Spark plans. The
driver's tables are pre-registered as views. Rounding is written another way
than in the library: of the value's decimal text; sums are whole numbers.
"""

from __future__ import annotations

from lamina.plans import fixtures


def R(expr: str, digits: int) -> str:
    """HALF_UP rounding of a double, from its shortest decimal text."""
    return f"cast(round(cast(cast({expr} as varchar) as decimal(38,16)), {digits}) as double)"


# Values are summed as whole numbers of 2^-64 (every bit of magnitudes from 2^-12 on), or of another unit.
BITS = 64


def _nearest(total: str, parts: str, bits: int = BITS) -> str:
    """The double nearest to total / parts (total in units of 2^-bits), from whole numbers only:
    a quotient of 60 bits whose last bit says whether anything was left over."""
    m = f"(cast(floor(log2(greatest(cast(abs({total}) as double) / {parts}, 1e-9))) as int) - 60)"
    up, down = f"cast(pow(2, greatest(0, -{m})) as hugeint)", f"cast(pow(2, greatest(0, {m})) as hugeint)"
    q = f"((abs({total}) * {up}) // ({parts} * {down}))"
    odd = f"(case when (abs({total}) * {up}) % ({parts} * {down}) > 0 and {q} % 2 = 0 then 1 else 0 end)"
    return (f"(case when {total} = 0 then 0.0::double else "
            f"sign({total}) * cast(cast({q} + {odd} as bigint) as double) * pow(2.0, {m} - {bits}) end)")


def _total(expr: str, bits: int = BITS) -> str:
    return f"sum(cast(cast({expr} as double) * {2.0 ** bits!r} as hugeint))"


def _sum_avg(expr: str, name: str, bits: int) -> str:
    total, one, n = _total(expr, bits), "cast(1 as hugeint)", f"cast(count({expr}) as hugeint)"
    return f"{_nearest(total, one, bits)} as {name}_sum, {_nearest(total, n, bits)} as {name}_avg"


def AVG(expr: str, digits: int) -> str:
    return R(_nearest(_total(expr), f"cast(nullif(count({expr}), 0) as hugeint)"), digits)


def SUM(expr: str, digits: int) -> str:
    return R(_nearest(_total(expr), "cast(1 as hugeint)"), digits)


def DIGITS(expr: str) -> str:
    return f"try_cast(nullif(regexp_replace({expr}, '[^0-9]', '', 'g'), '') as bigint)"


def ISO_DATE(expr: str) -> str:
    return f"case when regexp_matches({expr}, '^\\d{{4}}-\\d{{2}}-\\d{{2}}$') then try_cast({expr} as date) end"


def DURATION(expr: str) -> str:
    h = f"regexp_extract({expr}, '(\\d+)\\s*h', 1)"
    m = f"regexp_extract({expr}, '(\\d+)\\s*min', 1)"
    return f"case when {h} <> '' and {m} <> '' then try_cast(cast(try_cast({h} as int) as hugeint) * 60 + try_cast({m} as int) as int) end"


def FIRST(expr: str) -> str:
    return f"trim(string_split({expr}, ',')[1])"


def _raw_ctes(null_ids: bool = False) -> str:
    parts = [f"base as ({fixtures.BASE.format(part='part')})"]
    sources = fixtures.RAW_SQL | ({"movies": fixtures.MOVIES_WITH_NULL_IDS} if null_ids else {})
    parts += [f"raw_{name} as ({body})" for name, body in sources.items()]
    return ",\n".join(parts)


SCORE_CASE = (
    "case when puntuacion >= 8 then 'Excelente' when puntuacion >= 7 then 'Buena' "
    "when puntuacion >= 5 then 'Regular' else 'Baja' end"
)
DURATION_CASE = "case when duracion_min < 90 then 'Corta' when duracion_min <= 150 then 'Media' else 'Larga' end"

SILVER_COLS = (
    "id, titulo, generos, genero_principal, idioma, puntuacion, categoria_puntuacion, votos, "
    "duracion_min, categoria_duracion, duracion_consistente, fecha_estreno, anio_estreno, decada, "
    "director, actor_principal, reparto, presupuesto_usd, ingresos_usd, ganancia_usd, roi, poster_url"
)


def _film_ctes(null_ids: bool = True) -> str:
    return _raw_ctes(null_ids) + f""",
film as (
  select cast(id as int) as id, trim(title) as titulo, {ISO_DATE('release_date')} as fecha_estreno,
    cast(runtime_hour * 60 + runtime_min as int) as duracion_min,
    regexp_replace(trim(genres), '\\s*,\\s*', ', ', 'g') as generos, lower(trim(language)) as idioma,
    cast(user_score as double) as puntuacion, cast(vote_count as int) as votos
  from raw_movies where id is not null
  qualify row_number() over (partition by titulo, fecha_estreno, duracion_min order by id) = 1),
amounts as (
  select f.id, nullif(greatest(coalesce(d.budget_usd, {DIGITS('t.budget')}), 0), 0) as b,
    nullif(greatest(coalesce(d.revenue_usd, {DIGITS('t.revenue')}), 0), 0) as r, {DURATION('t.runtime')} as said
  from film f left join raw_film_details d on d.id = f.id left join raw_more_info t on t.film_id = f.id),
silver as (
  select f.id, titulo, generos, {FIRST('generos')} as genero_principal, idioma, puntuacion,
    {SCORE_CASE} as categoria_puntuacion, votos, duracion_min,
    {DURATION_CASE} as categoria_duracion, duracion_min = said as duracion_consistente,
    fecha_estreno, cast(year(fecha_estreno) as int) as anio_estreno,
    cast(year(fecha_estreno) // 10 * 10 as int) as decada,
    trim(d.director) as director, {FIRST('d.top_billed')} as actor_principal, trim(d.top_billed) as reparto,
    b as presupuesto_usd, r as ingresos_usd, r - b as ganancia_usd,
    case when b > 0 then {R('cast(r - b as double) / cast(b as double)', 2)} end as roi,
    p.poster_path as poster_url
  from film f join amounts a on a.id = f.id left join raw_film_details d on d.id = f.id
  left join raw_poster_path p on p.id = f.id),
genre as (
  select id, titulo, genero, puntuacion, votos, anio_estreno, presupuesto_usd, ingresos_usd, ganancia_usd
  from (select *, trim(unnest(string_split(generos, ','))) as genero from silver)
  where genero <> '')
"""


def _film(select: str, null_ids: bool = True) -> str:
    return f"with {_film_ctes(null_ids)}\n{select}"


def _bronze(name: str, cols: str) -> str:
    return f"with {_raw_ctes()}\nselect {cols}, 'csv' as source_ext from raw_{name}"


FILM_KPI_GENRE = f"""
select *, cast(dense_rank() over (order by ingresos_totales_usd desc nulls last) as int) as ranking_ingresos
from (
  select genero, count(*) as total_peliculas,
    {AVG('puntuacion', 2)} as puntuacion_promedio,
    try_cast(sum(votos) as bigint) as total_votos,
    {AVG('presupuesto_usd', 0)} as presupuesto_promedio_usd,
    try_cast(sum(ingresos_usd) as bigint) as ingresos_totales_usd,
    try_cast(sum(ganancia_usd) as bigint) as ganancia_total_usd
  from genre group by genero) g
"""

FILM_KPI_YEAR = f"""
select anio_estreno, decada, count(*) as total_peliculas,
  {AVG('puntuacion', 2)} as puntuacion_promedio,
  {AVG('duracion_min', 1)} as duracion_promedio_min,
  try_cast(sum(ingresos_usd) as bigint) as ingresos_totales_usd,
  try_cast(sum(ganancia_usd) as bigint) as ganancia_total_usd
from silver where anio_estreno is not null
group by anio_estreno, decada order by anio_estreno
"""

FILM_TOP_DIRECTORS = f"""
select cast(row_number() over (order by puntuacion_promedio desc nulls last,
         total_votos desc nulls last, director asc nulls first) as int) as ranking, *
from (
  select director, count(*) as total_peliculas,
    {AVG('puntuacion', 2)} as puntuacion_promedio,
    try_cast(sum(votos) as bigint) as total_votos,
    try_cast(sum(ingresos_usd) as bigint) as ingresos_totales_usd
  from silver where director is not null
  group by director having count(*) >= 3) d
"""

FILM_TOP_FILMS = """
select t.genero, t.ranking, t.id, t.titulo, t.puntuacion, t.votos, t.anio_estreno, s.poster_url
from (
  select *, cast(row_number() over (partition by genero
           order by puntuacion desc nulls last, votos desc nulls last, id asc nulls first) as int) as ranking
  from genre where votos >= 1000
  qualify ranking <= 10) t
left join (select id, poster_url from silver) s on t.id = s.id
"""

# The rounding edges of the query of that name.
EDGES = ("7.4949998", "2.4949996", "0.0049996", "1.005", "2.675", "0.125", "0.05", "1234567.445")

LINEITEM_REST = (
    "l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, "
    "l_returnflag, l_linestatus, l_shipdate"
)

ORACLE_SQL: dict[str, str] = {
    "csv_roundtrip": "select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, 'csv' as source_ext from customer",
    "csv_permissive": """
select case when c_custkey % 10 = 0 then null else c_custkey end as c_custkey,
  c_name, c_nationkey, c_acctbal, c_mktsegment
from customer""",
    "csv_records": """
select doc_id, md5(nullif(text, '')) as text_md5, source, nullif(lang, '') as lang, n_chars from documents""",
    "csv_rejects": """
with c as (select *, c_custkey % 10 = 0 as bad, concat_ws(',', 'xx', c_name, cast(c_nationkey as varchar),
    cast(c_acctbal as varchar), c_mktsegment) as raw from customer)
select 'kept' as policy, 'accepted' as route, case when not bad then c_custkey end as c_custkey, c_name, c_acctbal,
  cast(null as varchar) as raw_record from c
union all select 'kept', 'rejected', null, c_name, c_acctbal, raw from c where bad
union all select 'dropped', 'accepted', c_custkey, c_name, c_acctbal, null from c where not bad
union all select 'dropped', 'rejected', null, c_name, c_acctbal, raw from c where bad""",
    "sink_roundtrip": "select n_nationkey, n_name, n_regionkey from nation",
    "clean_text": """
select p_partkey, trim(concat('  ', p_name, ' ')) as name_clean,
  lower(trim(concat(' ', p_brand, ' '))) as brand_code,
  regexp_replace(trim(concat(p_type, ' ,', replace(p_name, ' ', '  , '))), '\\s*,\\s*', ', ', 'g') as type_list
from part""",
    "parse_digits": f"""
select c_custkey, amount_text, {DIGITS('amount_text')} as amount
from (
  select c_custkey,
    case c_custkey % 5
      when 0 then concat('$', cast(cast(floor(c_acctbal) as bigint) as varchar), ',000')
      when 1 then concat('-$', cast(c_custkey as varchar), '.50')
      when 2 then 'n/a'
      when 3 then concat('$', repeat('9', 20))
      else concat('USD ', cast(cast(floor(c_acctbal) as bigint) as varchar)) end as amount_text
  from customer) t""",
    "parse_iso_date": f"""
select o_orderkey, date_text, {ISO_DATE('date_text')} as parsed_date
from (
  select o_orderkey,
    case o_orderkey % 7
      when 0 then replace(cast(cast(o_orderdate as date) as varchar), '-', '/')
      when 1 then concat(cast(year(o_orderdate) as varchar), '-02-30')
      when 2 then concat(cast(year(o_orderdate) as varchar), '-13-45')
      else cast(cast(o_orderdate as date) as varchar) end as date_text
  from orders) t""",
    "duration_minutes": f"""
with {_raw_ctes()}
select id, duracion_min, minutes_in_text, duracion_min = minutes_in_text as duracion_consistente
from (
  select m.id, cast(m.runtime_hour * 60 + m.runtime_min as int) as duracion_min,
    {DURATION('i.runtime')} as minutes_in_text
  from raw_movies m left join raw_more_info i on m.id = i.film_id) t""",
    "first_item": "select p_partkey, "
    + FIRST("concat(' ', replace(p_name, ' ', ' , '), ' ')")
    + " as first_word from part",
    "buckets": """
select p_partkey, minutes, score,
  case when minutes < 90 then 'Corta' when minutes <= 150 then 'Media' else 'Larga' end as duration_bucket,
  case when score >= 8 then 'Excelente' when score >= 7 then 'Buena'
       when score >= 5 then 'Regular' else 'Baja' end as score_bucket
from (
  select p_partkey,
    cast(case when p_partkey % 13 = 0 then null else p_size * 4 end as int) as minutes,
    case when p_partkey % 11 = 0 then null else cast(p_size as double) / 5.0 end as score
  from part) t""",
    "calendar": """
select o_orderkey, cast(year(o_orderdate) as int) as order_year,
  cast(floor(year(o_orderdate) / 10) * 10 as int) as order_decade
from orders""",
    "prefer_positive": f"""
with {_raw_ctes()}
select id, presupuesto_usd, ingresos_usd, ingresos_usd - presupuesto_usd as ganancia_usd,
  case when presupuesto_usd > 0 then
    {R('cast(ingresos_usd - presupuesto_usd as double) / cast(presupuesto_usd as double)', 2)} end as roi
from (
  select d.id,
    case when coalesce(d.budget_usd, {DIGITS('i.budget')}) > 0
         then coalesce(d.budget_usd, {DIGITS('i.budget')}) end as presupuesto_usd,
    case when coalesce(d.revenue_usd, {DIGITS('i.revenue')}) > 0
         then coalesce(d.revenue_usd, {DIGITS('i.revenue')}) end as ingresos_usd
  from raw_film_details d left join raw_more_info i on d.id = i.film_id) t""",
    "filters": """
select d.doc_id, d.lang, d.n_chars, l.quality, l.toxic, l.toxic is null as toxic_unknown
from (select case when doc_id % 7 <> 3 then doc_id end as doc_id, case when doc_id % 5 <> 2 then lang end as lang,
        n_chars, case when doc_id % 4 = 1 then '   ' else text end as text from documents) d
left join labels l on d.doc_id = l.doc_id
where d.doc_id is not null and d.n_chars >= 200 and trim(d.text) <> '' and d.lang is not null
  and not (l.toxic = 1) and regexp_matches(d.text, '[A-Za-z]')""",
    "enrich_left": """
select d.doc_id, d.lang, d.source, l.quality, l.toxic
from documents d left join labels l on d.doc_id = l.doc_id""",
    "enrich_broadcast": """
select c_custkey, c_name, c_nationkey, n_name
from customer left join nation on c_nationkey = n_nationkey""",
    "enrich_hot_key": """
select l_orderkey, l_linenumber, l_suppkey, s_name
from (select l_orderkey, l_linenumber, case when l_orderkey % 2 = 0 then 7 when l_orderkey % 11 <> 5 then l_suppkey end as l_suppkey
      from lineitem) l left join supplier on s_suppkey = l_suppkey""",
    "opt_ins": """
select c_custkey, said,
  cast(case c_custkey % 6 when 0 then c_acctbal when 3 then 1000 + c_custkey % 1000 + 0.5 when 5 then -(c_custkey % 100) end as double) as money,
  case when minutes is null then 'Desconocida' when minutes < 90 then 'Corta' when minutes <= 150 then 'Media' else 'Larga' end
    as duration_bucket,
  case when score is null then 'Sin nota' when score >= 8 then 'Excelente' when score >= 7 then 'Buena'
       when score >= 5 then 'Regular' else 'Baja' end as score_bucket,
  coalesce(first, second) as preferred, case when first > 0 then first else second end as preferred_positive
from (
  select c_custkey, c_acctbal,
    case c_custkey % 6 when 0 then concat('$', cast(cast(c_acctbal as decimal(12,2)) as varchar)) when 1 then 'n/a' when 2 then '1.2.3'
      when 3 then concat('USD 1,', lpad(cast(c_custkey % 1000 as varchar), 3, '0'), '.5') when 4 then '5-3'
      else concat('-$', cast(c_custkey % 100 as varchar)) end as said,
    case when c_custkey % 6 <> 2 then cast(c_custkey % 200 as int) end as minutes,
    case when c_custkey % 6 <> 3 then (c_custkey % 100) / 10.0 end as score,
    case when c_custkey % 6 <> 4 then c_custkey % 3 - 1 end as first, c_custkey % 7 as second
  from customer) t""",
    "kpi_one_key": f"""
select l_returnflag, count(*) as total_rows,
  {AVG('l_quantity', 2)} as avg_qty, {SUM('l_quantity', 2)} as sum_qty,
  {AVG('l_extendedprice', 0)} as avg_price,
  {SUM('l_extendedprice * (1 - l_discount)', 2)} as sum_disc_price
from lineitem group by l_returnflag""",
    "kpi_two_keys": f"""
select cast(year(o_orderdate) as int) as order_year,
  cast(floor(year(o_orderdate) / 10) * 10 as int) as order_decade,
  count(*) as total_orders, {AVG('o_totalprice', 2)} as avg_price,
  {SUM('o_totalprice', 2)} as sum_price
from orders group by 1, 2""",
    "kpi_min_rows": f"""
select user_id, count(*) as total_events, {AVG('value', 2)} as avg_value,
  count(distinct event_type) as event_types
from events group by user_id having count(*) >= 60""",
    "kpi_mixed": f"""
select k, count(*) as total_rows, {R('any_value(edge)', 2)} as edge_avg, {_sum_avg('mixed', 'mixed', 0)},
  {_sum_avg('tiny', 'tiny', 100)}, isnan(sum(tax)) as tax_is_nan
from (select cast(l_orderkey % 8 as int) as k, cast([{', '.join(EDGES)}][l_orderkey % 8 + 1] as double) as edge,
        case when l_linenumber = 1 then 1e23 else l_quantity end as mixed, l_discount * 4.9e-7 as tiny,
        case when l_orderkey % 8 = 3 and l_linenumber = 2 then 'nan'::double else l_tax end as tax
      from lineitem) t
group by k""",
    "dedupe_first": f"""
select * from lineitem
qualify row_number() over (partition by l_orderkey, l_linenumber
  order by {', '.join(c.strip() + ' asc nulls first' for c in LINEITEM_REST.split(','))}) = 1""",
    "global_dense_rank": f"""
select l_suppkey, avg_disc, cast(dense_rank() over (order by avg_disc desc nulls last) as bigint) as disc_rank
from (select l_suppkey, {AVG('l_discount', 4)} as avg_disc from lineitem group by l_suppkey) t""",
    "global_row_number": f"""
select l_partkey, avg_disc, total_qty,
  cast(row_number() over (order by avg_disc desc nulls last, total_qty desc nulls last,
       l_partkey asc nulls first) as bigint) as part_rank
from (select l_partkey, {AVG('l_discount', 4)} as avg_disc, {SUM('l_quantity', 2)} as total_qty
      from lineitem group by l_partkey) t""",
    "global_row_number_rows": f"""
select l_orderkey, l_linenumber, l_extendedprice,
  cast(row_number() over (order by l_extendedprice desc nulls last, l_orderkey asc nulls first,
       l_linenumber asc nulls first,
       {', '.join(c.strip() + ' asc nulls first' for c in LINEITEM_REST.split(',') if c.strip() != 'l_extendedprice')}
  ) as bigint) as price_rank
from lineitem""",
    "global_dense_rank_rows": """
select l_orderkey, l_linenumber, l_quantity,
  cast(dense_rank() over (order by l_quantity desc nulls last) as bigint) as qty_rank
from lineitem""",
    "top_k_per_group": """
select t.event_id, t.event_type, t.user_id, t.value, t.ranking, e.props
from (
  select event_id, event_type, user_id, value,
    cast(row_number() over (partition by event_type order by value desc nulls last,
         event_id asc nulls first) as int) as ranking
  from events where value >= 100
  qualify ranking <= 10) t
left join (select event_id, props from events) e on t.event_id = e.event_id""",
    "explode_list": """
select p_partkey, word
from (select p_partkey, trim(unnest(string_split(p_name, ' '))) as word from part) t
where word <> ''""",
    "ordered_limit": """
select o_orderkey, o_custkey, o_totalprice from orders
order by o_totalprice desc nulls last, o_orderkey asc nulls first limit 10""",
    "quality_metrics": """
select count(*) as "rows", count(*) filter (where l_orderkey is null) as null_keys,
  count(distinct l_orderkey) as distinct_keys,
  count(l_orderkey) - count(distinct l_orderkey) as duplicate_keys,
  count(*) filter (where l_discount > cast(0.05 as double)) as discounted,
  count(*) filter (where l_returnflag = 'R') as returned,
  count(distinct l_partkey) as distinct_parts, count(distinct l_suppkey) as distinct_suppliers,
  count(distinct l_extendedprice) as distinct_prices
from lineitem""",
    "film_bronze_movies": _bronze(
        "movies",
        "id, title, genres, language, user_score, runtime_hour, runtime_min, "
        "nullif(release_date, '') as release_date, vote_count",
    ),
    "film_bronze_details": _bronze("film_details", "id, director, top_billed, budget_usd, revenue_usd"),
    "film_bronze_info": _bronze(
        "more_info", "id, runtime, nullif(budget, '') as budget, revenue, film_id"
    ),
    "film_bronze_posters": _bronze("poster_path", "id, poster_path, backdrop_path"),
    "film_silver": _film(f"select {SILVER_COLS} from silver"),
    "film_genre_rows": _film("select * from genre"),
    "film_kpi_genre": _film(FILM_KPI_GENRE),
    "film_kpi_year": _film(FILM_KPI_YEAR),
    "film_top_directors": _film(FILM_TOP_DIRECTORS),
    "film_top_films": _film(FILM_TOP_FILMS),
    "sink_replace": """
select o_orderkey, o_custkey, case when o_orderkey % 2 = 0 then -o_totalprice else o_totalprice end as o_totalprice
from orders""",
    "publish_conflict": """
select 5 as versions, 1 as writers, true as whole, 0 as foreign_rows, true as stale_refused,
  count(*) as reader_rows, 0 as reader_writer, true as catalog_agrees from orders""",
    "contract_drift": """
select cast(o_orderkey as bigint) as o_orderkey, cast(o_custkey as bigint) as o_custkey, o_totalprice,
  cast(null as varchar) as o_note, 'o_orderkey: bigint to int' as refused, true as unchanged from orders""",
    "ordered_files": """
select o_orderkey, o_totalprice, row_number() over (order by o_totalprice, o_orderkey) as place from orders""",
    "rounding": f"""
select p_partkey, edge, v, {R('v', 2)} as r2, {R('-v', 1)} as r1,
  case when p_partkey % 8 > 0 then
    {R('cast(p_partkey % 997 as double) / cast(p_partkey % 8 * 25 as double)', 2)} end as share
from (select p_partkey, edge, edge + cast(p_partkey % 100 as double) as v
      from part, (select cast(unnest([{', '.join(EDGES)}]) as double) as edge) e) t""",
    "overflow_parsing": f"""
with x as (
  select c_custkey, c_nationkey,
    case c_custkey % 6 when 0 then null when 1 then null when 2 then
        case when c_custkey % 60 <= 7 then 2147483640 + c_custkey % 60 end
      else (c_custkey % 5) * 60 + c_custkey % 60 end::int as minutes,
    case c_custkey % 6 when 3 then 999999999999999999 else c_custkey end::bigint as amount
  from customer)
select x.*, s.nation_sum, try_cast(cast(c_custkey as hugeint) * 1000000000 * 60 + 5 as int) as total
from x join (select c_nationkey, try_cast(sum(amount * 9) as bigint) as nation_sum from x group by 1) s
  on s.c_nationkey = x.c_nationkey""",
    "quality_gates": """
with o as (select count(*) as n, count(*) filter (where o_orderkey % 10 = 3) as marked from orders),
g as (select unnest(['not_empty', 'no_null_keys', 'unique_keys']) as gate),
t as (select unnest(['good', 'empty', 'null_ids', 'repeated']) as source)
select source, gate, case
    when source = 'empty' and gate = 'not_empty' then 'empty: not_empty: no rows'
    when source = 'null_ids' and gate = 'no_null_keys' and marked > 0
      then 'null_ids: no_null_keys: ' || marked || ' rows with a NULL key'
    when source = 'repeated' and gate = 'unique_keys' and marked > 0
      then 'repeated: unique_keys: ' || marked || ' repeated keys' end as failure
from t, g, o
union all select 'all', 'key_report', 'tables: repeated: ' || marked || ' repeated keys' from o where marked > 0""",
    "published_metrics": f"with {_film_ctes(False).rstrip()},\n" + """
counts as (
  select 'bronze' as step, 'movies' as table_name, count(*) as n from raw_movies
  union all select 'bronze', 'film_details', count(*) from raw_film_details
  union all select 'bronze', 'more_info', count(*) from raw_more_info
  union all select 'bronze', 'poster_path', count(*) from raw_poster_path
  union all select 'silver', 'peliculas', count(*) from silver
  union all select 'silver', 'peliculas_genero', count(*) from genre
  union all select 'golden', 'kpi_genero', count(distinct genero) from genre
  union all select 'golden', 'kpi_anual', count(distinct anio_estreno) from silver
  union all select 'golden', 'top_directores', count(*)
    from (select director from silver where director is not null group by 1 having count(*) >= 3)
  union all select 'golden', 'top_peliculas_genero', cast(sum(least(n, 10)) as bigint)
    from (select count(*) as n from genre where votos >= 1000 group by genero))
select timestamp '2024-05-06 07:08:09' as run_ts, step, table_name, n as row_count,
  case when step = 'bronze' then cast(0 as bigint) end as malformed,
  case when table_name = 'peliculas' then (select count(*) from raw_movies) - n end as duplicates_removed,
  case when table_name = 'peliculas' then (select count(*) from silver where fecha_estreno is null) end as undated,
  case when table_name = 'peliculas' then (select count(*) from silver where not duracion_consistente) end
    as inconsistent_duration
from counts""",
    "published_golden": _film(
        f"select *, timestamp '2024-05-06 07:08:09' as fecha_proceso from ({FILM_KPI_GENRE}) k", null_ids=False),
    "published_films": _film(
        f"select *, timestamp '2024-05-06 07:08:09' as fecha_proceso, cast(3 as bigint) as layers, "
        f"cast(10 as bigint) as tables from ({FILM_TOP_FILMS}) k", null_ids=False),
}

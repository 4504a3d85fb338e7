"""Table contracts: the fixed column order and type of every layer table.

The column names of the layer tables are the public output contract of the
catalogue job and are therefore kept verbatim (they are Spanish in the
original job); Python identifiers around them are English.

Types are built literally (``StructType.fromDDL`` needs a live session), so
importing this module never touches Spark.
"""

from __future__ import annotations

from pyspark.sql import types as T

_I, _L, _D, _S = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType()
_B, _DT, _TS = T.BooleanType(), T.DateType(), T.TimestampType()


def _struct(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


# Names of the two audit columns every bronze table carries.
INGEST_TS = "fecha_ingesta"
SOURCE_FILE = "archivo_origen"
# Fixed value: name of the run-timestamp column of silver and golden tables.
RUN_TS = "fecha_proceso"

AUDIT = ((INGEST_TS, _TS), (SOURCE_FILE, _S))

# Raw CSV files. Mapping is positional: header names in the file are ignored.
RAW = {
    "movies": _struct(
        ("id", _I), ("title", _S), ("genres", _S), ("language", _S),
        ("user_score", _D), ("runtime_hour", _I), ("runtime_min", _I),
        ("release_date", _S), ("vote_count", _I),
    ),
    "film_details": _struct(
        ("id", _I), ("director", _S), ("top_billed", _S),
        ("budget_usd", _L), ("revenue_usd", _L),
    ),
    "more_info": _struct(
        ("id", _I), ("runtime", _S), ("budget", _S), ("revenue", _S), ("film_id", _I),
    ),
    "poster_path": _struct(
        ("id", _I), ("poster_path", _S), ("backdrop_path", _S),
    ),
}

BRONZE = {name: _struct(*[(f.name, f.dataType) for f in s.fields], *AUDIT) for name, s in RAW.items()}

SILVER = {
    "peliculas": _struct(
        ("id", _I), ("titulo", _S), ("generos", _S), ("genero_principal", _S),
        ("idioma", _S), ("puntuacion", _D), ("categoria_puntuacion", _S),
        ("votos", _I), ("duracion_min", _I), ("categoria_duracion", _S),
        ("duracion_consistente", _B), ("fecha_estreno", _DT), ("anio_estreno", _I),
        ("decada", _I), ("director", _S), ("actor_principal", _S), ("reparto", _S),
        ("presupuesto_usd", _L), ("ingresos_usd", _L), ("ganancia_usd", _L),
        ("roi", _D), ("poster_url", _S), (RUN_TS, _TS),
    ),
    "peliculas_genero": _struct(
        ("id", _I), ("titulo", _S), ("genero", _S), ("puntuacion", _D), ("votos", _I),
        ("anio_estreno", _I), ("presupuesto_usd", _L), ("ingresos_usd", _L),
        ("ganancia_usd", _L), (RUN_TS, _TS),
    ),
}

GOLDEN = {
    "kpi_genero": _struct(
        ("genero", _S), ("total_peliculas", _L), ("puntuacion_promedio", _D),
        ("total_votos", _L), ("presupuesto_promedio_usd", _D),
        ("ingresos_totales_usd", _L), ("ganancia_total_usd", _L),
        ("ranking_ingresos", _I), (RUN_TS, _TS),
    ),
    "kpi_anual": _struct(
        ("anio_estreno", _I), ("decada", _I), ("total_peliculas", _L),
        ("puntuacion_promedio", _D), ("duracion_promedio_min", _D),
        ("ingresos_totales_usd", _L), ("ganancia_total_usd", _L), (RUN_TS, _TS),
    ),
    "top_directores": _struct(
        ("ranking", _I), ("director", _S), ("total_peliculas", _L),
        ("puntuacion_promedio", _D), ("total_votos", _L),
        ("ingresos_totales_usd", _L), (RUN_TS, _TS),
    ),
    "top_peliculas_genero": _struct(
        ("genero", _S), ("ranking", _I), ("id", _I), ("titulo", _S),
        ("puntuacion", _D), ("votos", _I), ("anio_estreno", _I),
        ("poster_url", _S), (RUN_TS, _TS),
    ),
}

# layer name -> {table name -> contract}
LAYERS = {"bronze": BRONZE, "silver": SILVER, "golden": GOLDEN}


def without(schema: T.StructType, *names: str) -> T.StructType:
    """``schema`` minus the named fields (e.g. the run timestamp for comparisons)."""
    return T.StructType([f for f in schema.fields if f.name not in names])

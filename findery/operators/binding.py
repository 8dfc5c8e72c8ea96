"""Field roles, binding of string tables to typed records, and projections by role."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


UNBOUND = "unbound"


def role_field(name: str, data_type: T.DataType, *, store: bool = False, index: bool = False) -> T.StructField:
    """A schema field whose roles (kept with the hit / searchable) are in its metadata."""
    return T.StructField(name, data_type, True, {"store": store, "index": index})


def _record(*fields: tuple[str, T.DataType, str]) -> T.StructType:
    return T.StructType(
        [role_field(n, t, store="store" in roles.split(), index="index" in roles.split()) for n, t, roles in fields]
    )


# The exam-question record, its types and the roles of its fields.
QUESTION = _record(
    ("Allid", T.IntegerType(), "store"),
    ("Id", T.StringType(), ""),
    ("Sn", T.StringType(), ""),
    ("Snid", T.StringType(), ""),
    ("Subject", T.StringType(), ""),
    ("Chapter", T.StringType(), ""),
    ("Node", T.StringType(), ""),
    ("Title", T.StringType(), "store index"),
    ("Choosea", T.StringType(), "store index"),
    ("Chooseb", T.StringType(), "store index"),
    ("Choosec", T.StringType(), "store index"),
    ("Choosed", T.StringType(), "store index"),
    ("Answer", T.StringType(), "store index"),
    ("Explain", T.StringType(), "store index"),
    ("Imageaddress", T.StringType(), ""),
    ("Remark", T.StringType(), "store index"),
)

# The stored fields a question hit is printed from, in order.
QUESTION_DISPLAY = ("Title", "Choosea", "Chooseb", "Choosec", "Choosed", "Answer", "Explain")


def has_role(field: T.StructField, role: str) -> bool:
    return bool((field.metadata or {}).get(role, False))


def indexed_fields(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields if has_role(f, "index")]


def stored_fields(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields if has_role(f, "store")]


def key_field(schema: T.StructType) -> str:
    """The record key: the first field that is stored and not indexed."""
    for f in schema.fields:
        if has_role(f, "store") and not has_role(f, "index"):
            return f.name
    raise ValueError("the schema has no field that is stored and not indexed")


def _zero(data_type: T.DataType) -> Column:
    value = 0 if isinstance(data_type, T.NumericType) else False if isinstance(data_type, T.BooleanType) else None
    return F.lit(value).cast(data_type)


def _sources(df: DataFrame, schema: T.StructType) -> dict[str, Column | None]:
    """Target name -> source column, matched without case; of several matches the last one counts."""
    by_name = {name.lower(): df[f"`{name}`"] for name in df.columns}
    return {f.name: by_name.get(f.name.lower()) for f in schema.fields}


def _converted(source: Column, field: T.StructField) -> Column:
    if isinstance(field.dataType, T.StringType):
        return F.coalesce(source.cast("string"), F.lit(""))
    return source.try_cast(field.dataType)


def bind(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Bind a table to a typed schema by name, ignoring case.

    Source columns without a target are dropped, targets without a source get the default of their
    type, a missing text is ``''``. A value that cannot be converted fails the job. Fields with a role
    that have no source are marked, so that storing or indexing them fails early (``require_fields``).
    """
    sources = _sources(df, schema)
    columns = []
    for field in schema.fields:
        source = sources[field.name]
        if source is None:
            value = _zero(field.dataType)
        elif isinstance(field.dataType, T.StringType):
            value = _converted(source, field)
        else:
            value = F.coalesce(
                _converted(source, field),
                F.raise_error(
                    F.concat(
                        F.lit(f"{field.name}: cannot convert to {field.dataType.simpleString()}: "),
                        F.coalesce(source.cast("string"), F.lit("a missing value")),
                    )
                ).cast(field.dataType),
            )
        marked = {UNBOUND: True} if source is None and (has_role(field, "store") or has_role(field, "index")) else {}
        columns.append(value.alias(field.name, metadata={**(field.metadata or {}), **marked}))
    return df.select(*columns)


def bind_permissive(df: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Like :func:`bind`, but bad rows go to a second table, with the names of the bad fields."""
    sources = _sources(df, schema)
    typed = [f for f in schema.fields if sources[f.name] is not None and not isinstance(f.dataType, T.StringType)]
    bad = F.array_compact(F.array(*[F.when(_converted(sources[f.name], f).isNull(), F.lit(f.name)) for f in typed]))
    if not typed:
        bad = F.array().cast("array<string>")
    checked = df.withColumn("bad_fields", bad)
    good = bind(checked.filter(F.size("bad_fields") == 0).drop("bad_fields"), schema)
    return good, checked.filter(F.size("bad_fields") > 0)


def require_fields(df: DataFrame, names: Sequence[str]) -> None:
    """Fail before the job starts when an annotated field has no column, here or in the table it was bound from."""
    missing = [n for n in names if n not in df.columns or (df.schema[n].metadata or {}).get(UNBOUND)]
    if missing:
        raise ValueError(f"no column for the fields {missing}")


def project_roles(df: DataFrame, schema: T.StructType | None = None) -> DataFrame:
    """The fields that are stored or indexed, as text, each with its roles."""
    schema = schema or df.schema
    kept = [f for f in schema.fields if has_role(f, "store") or has_role(f, "index")]
    require_fields(df, [f.name for f in kept])
    return df.select(*[F.col(f"`{f.name}`").cast("string").alias(f.name, metadata=f.metadata) for f in kept])


def drop_empty(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Leave out the records in which every one of these fields is missing."""
    return df.filter(F.coalesce(*[F.col(f"`{n}`").cast("string") for n in names]).isNotNull())


def to_fields(df: DataFrame, ids: Sequence[str], names: Sequence[str]) -> DataFrame:
    """One row per record and field: ``(*ids, field, text)``."""
    texts = [F.col(f"`{n}`").cast("string").alias(n) for n in names]
    return df.select(*ids, *texts).unpivot(list(ids), list(names), "field", "text")


def rendered(names: Sequence[str] = QUESTION_DISPLAY) -> Column:
    """The text shown for a hit: its stored fields, one after another."""
    return F.concat(*[F.coalesce(F.col(f"`{n}`").cast("string"), F.lit("")) for n in names])

"""Tables shaped as graph elements: vertices, edges, and the rules of their labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.merge import one_row_per_key

# Spark types and the property types of the graph store; others are TEXT.
PROPERTY_TYPES = {
    T.BooleanType: "BOOLEAN", T.ByteType: "BYTE", T.ShortType: "INT", T.IntegerType: "INT",
    T.LongType: "LONG", T.FloatType: "FLOAT", T.DoubleType: "DOUBLE",
    T.DateType: "DATE", T.TimestampType: "DATE", T.TimestampNTZType: "DATE",
}


def property_types(df: DataFrame) -> DataFrame:
    """``(property, data_type)`` of every column."""
    rows = [(f.name, PROPERTY_TYPES.get(type(f.dataType), "TEXT")) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "property string, data_type string")


def vertex_label(database: str, table: str) -> str:
    return f"{database}_{table}"


def key_id(*keys: str | Column, escape: bool = True) -> Column:
    """Vertex id from key columns. Separators inside a value are escaped, so ids are unique.

    NULL when a key is NULL. Values that cannot hold a separator need no escaping.
    """

    def text(k):
        col = (F.col(k) if isinstance(k, str) else k).cast("string")
        if escape:
            for ch in ("\\", "!"):
                col = F.replace(col, F.lit(ch), F.lit("\\" + ch))
        return col

    # concat, unlike concat_ws, is NULL as soon as one part is.
    parts = [text(keys[0])]
    for k in keys[1:]:
        parts += [F.lit("!"), text(k)]
    return F.concat(*parts)


def _id(df: DataFrame, keys: list[str]) -> Column:
    return key_id(*keys, escape=not all(isinstance(df.schema[k].dataType, T.NumericType) for k in keys))


def _complete(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys are all known."""
    absent = [k for k in keys if k not in df.columns]
    if absent:
        raise ValueError(f"key columns {absent} are not in the table")
    for k in keys:
        df = df.filter(F.col(k).isNotNull())
    return df


def vertices(df: DataFrame, label: str, keys: list[str] | None = None, order: list[str] | None = None) -> DataFrame:
    """``(id, label, <properties>)``, one row per key, the last by ``order``.

    Without keys the id is a hash of the row, the same on every run; equal rows are
    one vertex. Rows with a NULL key have no identity and are left out.
    """
    if keys:
        one = one_row_per_key(_complete(df, keys), keys, order)
        return one.select(_id(df, keys).alias("id"), F.lit(label).alias("label"), *[c for c in df.columns if c not in keys])
    whole = F.sha2(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}), 256)
    return df.distinct().select(whole.alias("id"), F.lit(label).alias("label"), *df.columns)


def edges(
    df: DataFrame,
    label: str,
    source_key: str | list[str],
    target_key: str | list[str],
    frequency: str = "SINGLE",
    sort_keys: list[str] | None = None,
    order: list[str] | None = None,
) -> DataFrame:
    """``(src, dst, label, <properties>)`` from the two endpoint keys of a table.

    ``SINGLE`` keeps one edge per pair, ``MULTIPLE`` one per pair and sort keys (all
    of them without sort keys); the last by ``order`` stays. Rows that lack an
    endpoint make no edge.
    """
    if frequency not in ("SINGLE", "MULTIPLE"):
        raise ValueError(f"unknown frequency {frequency!r}")
    sources = [source_key] if isinstance(source_key, str) else list(source_key)
    targets = [target_key] if isinstance(target_key, str) else list(target_key)
    sort_keys = sort_keys or []
    rows = _complete(df, [*sources, *targets])
    if frequency == "SINGLE" or sort_keys:
        # Deduplicated on the key columns themselves; the ids are built for what is left.
        keys = dict.fromkeys([*sources, *targets, *(sort_keys if frequency == "MULTIPLE" else [])])
        rows = one_row_per_key(rows, list(keys), order)
    ends = {*sources, *targets}
    return rows.select(
        _id(df, sources).alias("src"),
        _id(df, targets).alias("dst"),
        F.lit(label).alias("label"),
        *[c for c in df.columns if c not in ends or c in sort_keys],
    )


def dangling_ends(edge_rows: DataFrame, source_vertices: DataFrame, target_vertices: DataFrame) -> DataFrame:
    """``(end, id, n_edges)``: endpoint ids without a vertex, and how many edges use them.

    Edges are counted per endpoint before the anti join, so an endpoint shared by a
    third of the edges is one row in it.
    """

    def missing(end: str, column: str, vertex_rows: DataFrame) -> DataFrame:
        used = edge_rows.groupBy(F.col(column).alias("id")).agg(F.count(F.lit(1)).alias("n_edges"))
        lost = used.join(vertex_rows.select("id"), "id", "left_anti")
        return lost.select(F.lit(end).alias("end"), "id", "n_edges")

    return missing("source", "src", source_vertices).unionByName(missing("target", "dst", target_vertices))


def valid_edges(edge_rows: DataFrame, source_vertices: DataFrame, target_vertices: DataFrame) -> DataFrame:
    """Edges whose two endpoints exist."""
    return edge_rows.join(
        source_vertices.select(F.col("id").alias("src")), "src", "left_semi"
    ).join(target_vertices.select(F.col("id").alias("dst")), "dst", "left_semi").select(*edge_rows.columns)

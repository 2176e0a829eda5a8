"""A property graph as one DataFrame per node label and per edge type."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.dedup import keep_first
from ..operators.mentions import extract_mentions, keyword_dictionary
from ..session import broadcast_limit, materialize, tasks_for
from ..sources.files import read_table, write_table
from ..sources.upsert import merged_rows, upsert_edges, upsert_nodes
from .ontology import ORDERS, EdgeRule, NodeRule, Ontology, same_as_rule

#: Edges that one task proves and merges, where they are dealt over tasks.
_TASK_ROWS = 250_000


def node_rows(rule: NodeRule, table: DataFrame) -> DataFrame:
    """Nodes of one label: (id, properties); keys are never null, and listed sentinel keys are left out."""
    columns = [
        (F.col(column).cast("string") if name in rule.as_text else F.col(column)).alias(name)
        for name, column in rule.properties.items()
    ]
    rows = table.select(F.col(rule.key).alias("id"), *columns).filter(F.col("id").isNotNull())
    if rule.drop_keys:
        rows = rows.filter(~F.col("id").isin(*rule.drop_keys))
    if not rule.distinct:
        return rows
    if not rule.properties:
        return rows.distinct()
    return keep_first(rows, ["id"], [F.col(n).asc_nulls_last() for n in rule.properties])


def edge_rows(rule: EdgeRule, table: DataFrame, drop_targets: tuple[str, ...] = ()) -> DataFrame:
    """Edges of one type as the table holds them: (src, dst, properties), endpoints never null."""
    columns = [F.col(column).alias(name) for name, column in rule.properties.items()]
    rows = table.select(F.col(rule.src).alias("src"), F.col(rule.dst).alias("dst"), *columns)
    rows = rows.filter(F.col("src").isNotNull() & F.col("dst").isNotNull())
    return rows.filter(~F.col("dst").isin(*drop_targets)) if drop_targets else rows


def _looked_up(ids: DataFrame) -> DataFrame:
    """``ids`` as the side of a join that a task holds, be they too many to be broadcast; else it would sort the other side."""
    size = int(ids._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return ids if size <= broadcast_limit(ids.sparkSession) else ids.hint("shuffle_hash")


class Graph:
    """Nodes and edges of an ontology, read lazily from tables.

    ``tables`` gives the DataFrame of a table name. ``loaded`` says that the tables are those :meth:`save` wrote, in which
    keys are unique and endpoints exist, so that nothing has to be checked again. An edge of the graph is a row whose two
    endpoints are nodes of it; every method but :meth:`table_edges` returns such rows only.
    """

    def __init__(self, ontology: Ontology, tables: Callable[[str], DataFrame], loaded: bool = False):
        self.ontology = ontology
        self._tables = tables
        self._loaded = loaded
        self._own_nodes: dict[str, DataFrame] = {}
        self._own_edges: dict[str, DataFrame] = {}

    def _copy(self, ontology: Ontology) -> Graph:
        copy = Graph(ontology, self._tables, self._loaded)
        copy._own_nodes, copy._own_edges = dict(self._own_nodes), dict(self._own_edges)
        return copy

    def with_edges(self, rule: EdgeRule, table: DataFrame) -> Graph:
        """The graph with one more edge type, whose columns ``rule`` names in ``table``."""
        copy = self._copy(Ontology(self.ontology.nodes, (*self.ontology.edges, rule)))
        copy._own_edges[rule.type] = edge_rows(rule, table)
        return copy

    def with_same_as(self, label: str, resolved: DataFrame) -> Graph:
        """The graph with the same-as edges (id_a, id_b, confidence) of one label."""
        return self.with_edges(same_as_rule(label), resolved)

    def with_property(self, label: str, values: DataFrame, column: str, name: str) -> Graph:
        """The graph with a property of the nodes of one label taken from (id, ``column``); null where there is none."""
        found = values.select("id", F.col(column).alias(name))
        copy = self._copy(self.ontology)
        copy._own_nodes[label] = self.nodes(label).drop(name).join(found, "id", "left")
        return copy

    def nodes(self, label: str) -> DataFrame:
        if label in self._own_nodes:
            return self._own_nodes[label]
        if self._loaded:
            return self._tables(f"nodes/{label}")
        return node_rows(self.ontology.node(label), self._tables(self.ontology.node(label).table))

    def _ids(self, label: str) -> DataFrame:
        """(id) of the nodes of one label, once each."""
        rule = self.ontology.node(label)
        if self._loaded or label in self._own_nodes or not rule.distinct:
            return self.nodes(label).select("id")
        return node_rows(replace(rule, properties={}), self._tables(rule.table))

    def table_edges(self, type: str) -> DataFrame:
        """Edges as their table holds them, whether or not their endpoints are nodes."""
        if type in self._own_edges:
            return self._own_edges[type]
        if self._loaded:
            return self._tables(f"edges/{type}")
        rule = self.ontology.edge(type)
        return edge_rows(rule, self._tables(rule.table), self.ontology.node(rule.dst_label).drop_keys)

    def raw_edges(self, type: str, near: DataFrame | None = None, tasks: int | None = None) -> DataFrame:
        """Edges with their properties, before duplicates are merged.

        With ``near``, only edges of its ``src`` nodes. That is asked first, so that only what is left has to prove its
        endpoints, and of the node tables only these endpoints are looked for. With ``tasks``, edges are dealt over so many by
        ``src`` once their other end is proven, and Spark does not merge these tasks. Their ``src`` is then proven by a join with
        distinct ids, dealt alike: a semi-join would be moved before the dealing, into tasks that hold more the larger the table is.
        """
        rows = self.table_edges(type)
        columns = rows.columns
        if near is not None:
            rows = rows.join(near.select("src"), "src", "left_semi").select(columns)
        own = type in self._own_edges
        if self._loaded and not own:
            return rows
        rule = self.ontology.edge(type)
        ends = [("src", rule.src_label, rule.src), ("dst", rule.dst_label, rule.dst)]
        for column, label, source in reversed(ends) if tasks else ends:
            rows = rows.repartition(tasks, "src") if tasks and column == "src" else rows
            node = self.ontology.node(label)
            made_of_edges = not own and label not in self._own_nodes and (node.table, node.key) == (rule.table, source)
            if not made_of_edges:  # else every row of the table is a node as well
                ids = self._ids(label).select(F.col("id").alias(column))
                if near is not None:
                    ids = ids.join(rows.select(column).distinct(), column, "left_semi")
                if tasks and column == "src":
                    rows = rows.join(_looked_up(ids.repartition(tasks, column).distinct()), column)
                else:
                    rows = rows.join(_looked_up(ids) if tasks else ids, column, "left_semi")
        return rows.select(columns)

    def links(self, type: str, near: DataFrame | None = None) -> DataFrame:
        """One row per edge, without the properties that do not identify it.

        With ``near``, only edges of its ``src`` nodes: the others are dropped before duplicates are merged, so a query
        around a few nodes shuffles their edges only.
        """
        rule = self.ontology.edge(type)
        rows = self._around(type, near).select("src", "dst", *rule.identity)
        return rows if self._unique(type) else rows.distinct()

    def pairs(self, type: str, near: DataFrame | None = None, dealt: bool = False) -> DataFrame:
        """Distinct (src, dst): which nodes are connected at all; ``near`` as in :meth:`links`.

        With ``dealt``, the table is counted, and the more rows it has, the more tasks there are; else what a task holds grows.
        """
        tasks = None
        if dealt and (type in self._own_edges or not self._loaded):
            edges = self.table_edges(type)
            tasks = tasks_for(edges.sparkSession, edges.count(), _TASK_ROWS)
        rows = self.raw_edges(type, near, tasks).select("src", "dst")
        return rows if self._unique(type) and not self.ontology.edge(type).identity else rows.distinct()

    def _unique(self, type: str) -> bool:
        return self._loaded and type not in self._own_edges

    def _around(self, type: str, near: DataFrame | None) -> DataFrame:
        return self.raw_edges(type, near)

    def merged_edges(self, type: str) -> DataFrame:
        """Edges as an upsert leaves them: unique by endpoints and identity."""
        rows = self.raw_edges(type)
        return rows if self._unique(type) else merged_rows(rows, self.ontology.edge(type).identity).select(rows.columns)

    def typed_links(self, types: list[str] | None = None) -> list[tuple[str, str, Callable[[], DataFrame]]]:
        """(source label, target label, function giving rows of src and dst as text) per edge type, for searches over any type.

        An edge type costs nothing, such as the extraction of what its table holds, before a search calls its function.
        """

        def rows(type: str) -> Callable[[], DataFrame]:
            return lambda: self.raw_edges(type).select(F.col("src").cast("string"), F.col("dst").cast("string"))

        chosen = [rule for rule in self.ontology.edges if types is None or rule.type in types]
        return [(rule.src_label, rule.dst_label, rows(rule.type)) for rule in chosen]

    def save(self, path: str, max_records_per_file: int = 0, fill: str | None = None) -> None:
        """Write every node and edge table; with ``fill``, nulls in text properties of nodes become that text."""
        for rule in self.ontology.nodes:
            rows = self.nodes(rule.label) if fill is None else fill_properties(self.nodes(rule.label), fill)
            write_table(rows, f"{path}/nodes/{rule.label}", max_records_per_file)
        for edge in self.ontology.edges:
            write_table(self.merged_edges(edge.type), f"{path}/edges/{edge.type}", max_records_per_file)

    def merge_into(self, saved: Graph, path: str, max_records_per_file: int = 0) -> None:
        """Upsert this graph into a saved one and write the result to a new path.

        Edge types that only the saved graph knows are written as they are.
        """
        merged_nodes = {}
        for rule in saved.ontology.nodes:
            merged = upsert_nodes(saved.nodes(rule.label), self.nodes(rule.label), "id")
            write_table(merged, f"{path}/nodes/{rule.label}", max_records_per_file)
            merged_nodes[rule.label] = merged.sparkSession.read.schema(merged.schema).parquet(f"{path}/nodes/{rule.label}")
        types = {edge.type for edge in saved.ontology.edges}
        for edge in (*saved.ontology.edges, *(e for e in self.ontology.edges if e.type not in types)):
            ends = merged_nodes[edge.src_label], merged_nodes[edge.dst_label]
            old = saved.raw_edges(edge.type) if edge.type in types else None
            known = any(e.type == edge.type for e in self.ontology.edges)
            merged = upsert_edges(old, self.table_edges(edge.type), *ends, edge.identity) if known else old
            write_table(merged, f"{path}/edges/{edge.type}", max_records_per_file)


def fill_properties(nodes: DataFrame, value: str = "") -> DataFrame:
    """Nodes with ``value`` in place of nulls in their text properties; the key is left alone."""
    return nodes.fillna(value, [name for name, kind in nodes.dtypes if kind == "string" and name != "id"])


def load_graph(spark, path: str, ontology: Ontology) -> Graph:
    """The graph that :meth:`Graph.save` wrote."""
    return Graph(ontology, lambda name: spark.read.parquet(f"{path}/{name}"), loaded=True)


def orders_graph(
    spark, folder: str, titles: tuple[str, str] = ("benchmark", "text"), only: dict[str, str] | None = None
) -> Graph:
    """The graph over the order-processing tables of a folder; concepts are the words of a table of titles.

    ``only`` maps a table to a condition on its rows, for a graph from which nodes are missing.
    """

    held: dict[str, DataFrame] = {}

    def table(name: str) -> DataFrame:
        if name != "concepts":
            rows = read_table(spark, folder, name)
            return rows.filter(only[name]) if only and name in only else rows
        if not held:  # the texts are read once, however many nodes and edges come from them
            dictionary = keyword_dictionary(read_table(spark, folder, titles[0], titles[1]), titles[1])
            docs = read_table(spark, folder, "documents", "doc_id", "text")
            held["concepts"] = materialize(extract_mentions(docs, dictionary, "doc_id", "text"), "concepts")
        return held["concepts"]

    return Graph(ORDERS, table)


def detach_delete(nodes: dict[str, DataFrame], edges: dict[str, DataFrame], ontology: Ontology, label: str):
    """Remove a label with all edges at its nodes; returns the remaining nodes and edges.

    An edge type has one source and one target label, so no edge has to be read to know that it goes.
    """
    gone = {rule.type for rule in ontology.edges if label in (rule.src_label, rule.dst_label)}
    return (
        {name: df for name, df in nodes.items() if name != label},
        {name: df for name, df in edges.items() if name not in gone},
    )


def pack_endpoints(edges: DataFrame, src_label: str, dst_label: str) -> DataFrame:
    """Edges with their endpoints as (label, id) structs, for sinks that expect such a shape."""
    return edges.select(
        F.struct(F.lit(src_label).alias("label"), F.col("src").alias("id")).alias("source"),
        F.struct(F.lit(dst_label).alias("label"), F.col("dst").alias("id")).alias("target"),
        *[c for c in edges.columns if c not in ("src", "dst")],
    )

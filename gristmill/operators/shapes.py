"""Nested records to flat child tables, by structural variants (problem 3).

A deterministic bottom-up tree automaton gives every child value a state from the shape of
its subtree. Children of all states share one supertype table (parent key, two positions,
state, name), which is written once, in one folder for each kind and state; a state's subtype
table reads its own folder and gives it typed columns. The shape of a value is taken in the
JVM (``schema_of_variant``); the automaton runs over the short shape strings, once per
distinct shape and worker.

Cases: null parents, null or missing arrays and invalid JSON give no children; null elements
keep their position and get the state ``void``; a single value in place of an array is its
only element; repeats stay; other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.session import stage

VOID, LIST, OTHER = "void", "list", "other"
LEAVES = {
    "VOID": VOID, "STRING": "text", "BOOLEAN": "flag", "BIGINT": "number", "DOUBLE": "number", "FLOAT": "number",
    "DATE": "text", "TIMESTAMP": "text", "TIMESTAMP_NTZ": "text", "VARIANT": OTHER, "BINARY": OTHER,
}


@dataclass(frozen=True)
class Rule:
    """An object with these keys in these states (given as ``a|b``) is in ``state``; other keys are free."""

    state: str
    keys: Mapping[str, str] = field(default_factory=dict)


def read_shape(text: str) -> tuple:
    """The tree of a ``schema_of_variant`` string: ("LEAF",), ("ARRAY", child) or ("OBJECT", {key: child})."""

    def node(i: int) -> tuple[tuple, int]:
        if text.startswith("ARRAY<", i):
            child, i = node(i + 6)
            return ("ARRAY", child), i + 1
        if text.startswith("OBJECT<", i):
            fields: dict[str, tuple] = {}
            i += 7
            while text[i] != ">":
                if text[i] == "`":
                    end = i + 1
                    while text[end] != "`" or text[end + 1] == "`":
                        end += 2 if text[end] == "`" else 1
                    key, i = text[i + 1 : end].replace("``", "`"), end + 3
                else:
                    end = text.index(": ", i)
                    key, i = text[i:end], end + 2
                fields[key], i = node(i)
                i += 2 if text[i] == "," else 0
            return ("OBJECT", fields), i + 1
        end = i
        while end < len(text) and text[end] not in ",>":
            end += 1 if text[end] != "(" else text.index(")", end) - end + 1
        return (text[i:end],), end

    return node(0)[0]


class TreeAutomaton:
    """Bottom-up: leaves by type, arrays to ``list``, objects to the first rule that their keys' states meet."""

    def __init__(self, rules: list[Rule], leaves: Mapping[str, str] = LEAVES):
        self.rules, self.leaves = list(rules), dict(leaves)
        self._seen: dict[str, str] = {}

    def run(self, tree: tuple) -> str:
        if tree[0] == "ARRAY":
            return LIST
        if tree[0] != "OBJECT":
            return self.leaves.get(tree[0].split("(")[0], "number" if tree[0].startswith("DECIMAL") else OTHER)
        below = {key: self.run(child) for key, child in tree[1].items()}
        for rule in self.rules:
            if all(below.get(key, VOID) in states.split("|") for key, states in rule.keys.items()):
                return rule.state
        return OTHER

    def classify(self, shape: str | None) -> str:
        if shape is None:
            return VOID
        if (state := self._seen.get(shape)) is None:
            try:
                state = self.run(read_shape(shape))
            except (IndexError, ValueError, RecursionError):  # a shape beyond the grammar
                state = OTHER
            self._seen[shape] = state
            if len(self._seen) > 100_000:
                self._seen.clear()
        return state

    def column(self, shape: Column) -> Column:
        """The state of each shape string."""

        def states(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for batch in batches:
                yield batch.map(self.classify)

        return F.pandas_udf(states, "string")(shape)


def shape_of(value: Column) -> Column:
    return F.schema_of_variant(value)


def valid_json(text: Column) -> Column:
    """The variant of a text that is one whole JSON value; null for anything else."""
    return F.when(F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1, F.try_parse_json(text))


def as_list(name: str) -> Column:
    """A variant as an array: itself, or its only element; null for null."""
    one = F.col(name)
    return F.when(one.isNull() | F.expr(f"is_variant_null({name})"), F.lit(None)).otherwise(
        F.coalesce(F.expr(f"try_variant_get({name}, '$', 'array<variant>')"), F.array(one))
    )


def page_hits(pages: DataFrame, *keep: str) -> DataFrame:
    """(page_id, kept columns, pos1, hit) of every captured answer's hits, over all of its result lists in order."""
    body = pages.select("page_id", *keep, valid_json(F.col("body")).alias("body"))
    lists = body.select(
        "page_id",
        *keep,
        F.expr("try_variant_get(body, '$.hits', 'variant')").alias("own"),
        F.expr("try_variant_get(body, '$.results', 'variant')").alias("results"),
    ).withColumns({"own": as_list("own"), "results": as_list("results")})
    nested = F.expr(
        "flatten(transform(results, r -> coalesce("
        "try_variant_get(r, '$.hits', 'array<variant>'),"
        "array_compact(array(try_variant_get(r, '$.hits', 'variant'))), array())))"
    )
    return lists.select(
        "page_id",
        *keep,
        F.posexplode(F.concat(F.coalesce("own", F.expr("array()")), F.coalesce(nested, F.expr("array()")))).alias("pos1", "hit"),
    )


NAMED = Rule("labelled", {"name": "text"})
AUTHOR_RULES = [
    Rule("registered", {"display_name": "text", "id": "text", "orcid": "text"}),
    Rule("identified", {"display_name": "text", "id": "text"}),
    Rule("named", {"display_name": "text"}),
    Rule("unnamed"),
]
INSTITUTION_RULES = [
    Rule("registered", {"display_name": "text", "ror": "text"}),
    Rule("identified", {"display_name": "text", "id": "text"}),
    Rule("named", {"display_name": "text"}),
    Rule("unnamed"),
]
INDUSTRY_RULES = [Rule("identified", {"name": "text", "id": "number|text"}), NAMED, Rule("unnamed")]

#: Typed columns of the subtype tables: kind -> state -> {column: type}.
SUBTYPES = {
    "author": {
        "registered": {"id": "string", "orcid": "string", "display_name": "string"},
        "identified": {"id": "string", "display_name": "string"},
        "named": {"display_name": "string"},
        "unnamed": {"id": "string", "orcid": "string"},
    },
    "institution": {
        "registered": {"id": "string", "ror": "string", "display_name": "string", "country_code": "string", "type": "string"},
        "identified": {"id": "string", "display_name": "string", "country_code": "string", "type": "string"},
        "named": {"display_name": "string", "country_code": "string", "type": "string"},
        "unnamed": {"id": "string", "ror": "string", "country_code": "string"},
    },
    "industry": {"identified": {"id": "string", "name": "string"}, "labelled": {"name": "string"}, "unnamed": {"id": "string"}},
}
#: Typed columns of children that are no objects of a known shape: state -> {column: SQL}. A text is its own name.
LOOSE = {
    VOID: {},
    "text": {},
    "number": {"value": "try_variant_get(child, '$', 'double')"},
    "flag": {"value": "try_variant_get(child, '$', 'boolean')"},
    LIST: {"json": "to_json(child)"},
    OTHER: {"json": "to_json(child)"},
}
KEYS = ["parent_id", "pos1", "pos2", "name"]


@dataclass
class ShapeTables:
    """``super``: kind, state, parent_id, pos1, pos2, name, child; staged. ``subtype(state, kind)``: keys and typed columns."""

    super: DataFrame
    kinds: list[str]

    def states(self, kind: str) -> list[str]:
        """Every state a child of this kind can have."""
        return [*SUBTYPES[kind], *LOOSE]

    def subtype(self, state: str, kind: str | None = None) -> DataFrame:
        """The rows of one state of one kind (the tables' first, if none is given)."""
        kind = kind or self.kinds[0]
        if state in LOOSE:
            typed = LOOSE[state]
        else:
            typed = {c: f"try_variant_get(child, '$.{c}', '{t}')" for c, t in SUBTYPES[kind][state].items()}
        rows = self.super.filter((F.col("kind") == kind) & (F.col("state") == state))
        return rows.select(*KEYS, *[F.expr(sql).alias(f"child_{c}") for c, sql in typed.items()])

    def all_subtypes(self, *columns: str) -> DataFrame:
        """These columns of every subtype table, with the kind; together they hold each child once."""
        parts = None
        for kind in self.kinds:
            for state in self.states(kind):
                each = self.subtype(state, kind).select(F.lit(kind).alias("kind"), *columns)
                parts = each if parts is None else parts.unionByName(each)
        return parts


def _classified(kind: str, children: DataFrame, rules: list[Rule], name: str) -> DataFrame:
    """children: parent_id, pos1, pos2, child (a variant). Rows of the supertype table."""
    state = TreeAutomaton(rules).column(shape_of(F.col("child")))
    named = F.coalesce(
        F.when(shape_of(F.col("child")) == "STRING", F.expr("try_variant_get(child, '$', 'string')")),
        F.when(F.expr(f"schema_of_variant(try_variant_get(child, '$.{name}', 'variant'))") == "STRING", F.expr(f"try_variant_get(child, '$.{name}', 'string')")),
    )
    return children.select(
        "parent_id",
        F.col("pos1").cast("int").alias("pos1"),
        F.col("pos2").cast("int").alias("pos2"),
        named.alias("name"),
        "child",
        F.lit(kind).alias("kind"),
        state.alias("state"),
    )


def author_children(works: DataFrame) -> DataFrame:
    at = works.select(F.col("id").alias("parent_id"), F.posexplode("authorships").alias("pos1", "a"))
    return _classified("author", at.select("parent_id", "pos1", F.lit(-1).alias("pos2"), F.to_variant_object("a.author").alias("child")), AUTHOR_RULES, "display_name")


def institution_children(works: DataFrame) -> DataFrame:
    at = works.select(F.col("id").alias("parent_id"), F.posexplode("authorships").alias("pos1", "a"))
    each = at.select("parent_id", "pos1", F.posexplode("a.institutions").alias("pos2", "i"))
    return _classified("institution", each.select("parent_id", "pos1", "pos2", F.to_variant_object("i").alias("child")), INSTITUTION_RULES, "display_name")


def industry_children(pages: DataFrame) -> DataFrame:
    hits = page_hits(pages).select(F.col("page_id").cast("string").alias("parent_id"), "pos1", F.expr("try_variant_get(hit, '$.industries', 'variant')").alias("many"))
    each = hits.select("parent_id", "pos1", F.posexplode(as_list("many")).alias("pos2", "child"))
    return _classified("industry", each, INDUSTRY_RULES, "name")


def shape_tables(**children: DataFrame) -> ShapeTables:
    """The tables of all these children, by kind; every child is classified and written once."""
    whole = None
    for part in children.values():
        whole = part if whole is None else whole.unionByName(part)
    return ShapeTables(stage(whole, "shapes", ["kind", "state"]), list(children))


def author_tables(works: DataFrame) -> ShapeTables:
    return shape_tables(author=author_children(works))


def institution_tables(works: DataFrame) -> ShapeTables:
    return shape_tables(institution=institution_children(works))


def industry_tables(pages: DataFrame) -> ShapeTables:
    return shape_tables(industry=industry_children(pages))


def record_tables(works: DataFrame, pages: DataFrame) -> ShapeTables:
    """The tables of the authors and institutions of works and of the industries in captured pages."""
    return shape_tables(author=author_children(works), institution=institution_children(works), industry=industry_children(pages))


def non_blank(name: str) -> Column:
    return F.col(name).rlike(r"(?U)\S")


def named_children(works: DataFrame, pages: DataFrame) -> DataFrame:
    """(kind, parent_id, pos1, pos2) of every child with a non-blank name, as the union of all subtype tables."""
    return record_tables(works, pages).all_subtypes(*KEYS).filter(non_blank("name")).drop("name")


def variant_counts(works: DataFrame, pages: DataFrame) -> DataFrame:
    """Children of each kind and state, with how many of them are named."""
    return record_tables(works, pages).super.groupBy("kind", "state").agg(F.count("*").alias("n"), F.count_if(non_blank("name")).alias("n_named"))

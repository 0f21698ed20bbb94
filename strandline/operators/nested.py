"""Nested records as related flat tables, linked by interval labels (problem 1).

Every node of a record - the record, each exposure, block, measure, term and number -
gets the pre-order and post-order number of a depth-first walk. A node contains another
exactly if its pre number is smaller and its post number larger. In pre-order all that a
node contains stands right behind it, so its interval is a slice of the record's array of
nodes: the flat tables are cut from that array level by level, each row with the pre number
of its parent, before anything is exploded. Nothing is shuffled and no pair of nodes formed.

Typed columns are walked by native expressions: each record becomes an array of nodes in
pre-order (its index is the pre number) with depth and subtree size, from which
``post = pre - depth + size - 1``. JSON payloads are walked by an Arrow-batched function
along the same schema, so the same record has the same labels either way.

Results for odd input: null or empty ``exposures`` give a record node only; null elements
keep their number and have no children; null blocks and measures give no node; null
elements of ``vals`` are skipped and not counted. A payload that is null, empty, broken or
no JSON object gives a record node only; one nested too deep for the usual parser is read
by a loop. Rows are independent, so repeated rows and ids stay apart. Extra columns are ignored.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from strandline.functions.text import let

NODE = "struct<kind:string,name:string,ordinal:int,depth:int,size:int,num:double,text:string>"

# The blocks of an exposure and the measures in each.
BLOCKS = {
    "exposure": ("fundamental_frequency_khz",),
    "free_field": ("pressure_kpa", "isppa_w_cm2", "ispta_w_cm2"),
    "in_situ": ("pressure_kpa", "isppa_w_cm2", "ispta_w_cm2"),
    "unspecified_domain": ("pressure_kpa", "isppa_w_cm2", "ispta_w_cm2"),
    "timing": ("pulse_duration_ms", "pulse_repetition_frequency_hz", "duty_cycle_pct", "sonication_duration_s"),
}


def _node(kind: str, name: Column, ordinal: Column, depth: int, size: Column, num: Column | None = None, text: Column | None = None) -> Column:
    none = F.lit(None)
    return F.struct(
        F.lit(kind).alias("kind"), name.cast("string").alias("name"), ordinal.cast("int").alias("ordinal"), F.lit(depth).alias("depth"),
        size.cast("int").alias("size"), (none if num is None else num).cast("double").alias("num"), (none if text is None else text).cast("string").alias("text"),
    )


def _with(head, children: Column) -> Column:
    """The node ``head(size)`` followed by its children, which are evaluated once."""
    return F.flatten(F.transform(F.array(children), lambda ch: F.concat(F.array(head(F.size(ch) + 1)), ch)))


def _none() -> Column:
    return F.array().cast(f"array<{NODE}>")


def is_measure(t: DataType) -> bool:
    return isinstance(t, StructType) and set(t.fieldNames()) == {"state", "vals", "is_list"}


def walk(value: Column, kind: DataType, name: str, depth: int) -> Column:
    """Nodes, in pre-order, of one column or field of any nested type."""
    lit = F.lit(name)
    if is_measure(kind):
        nums = F.filter(value.vals, lambda v: v.isNotNull())
        kids = F.coalesce(F.transform(nums, lambda v, i: _node("value", F.lit(None), i, depth + 1, F.lit(1), v)), _none())
        got = _with(lambda n: _node("measure", lit, F.lit(None), depth, n, None, value.state), kids)
    elif isinstance(kind, StructType):
        kids = [walk(value[f.name], f.dataType, f.name, depth + 1) for f in kind.fields if isinstance(f.dataType, (StructType, ArrayType))]
        got = _with(lambda n: _node("block", lit, F.lit(None), depth, n), F.concat(*kids) if kids else _none())
    elif isinstance(kind, ArrayType) and isinstance(kind.elementType, StructType):
        el = kind.elementType
        inner = [f for f in el.fields if isinstance(f.dataType, (StructType, ArrayType))]

        def element(x: Column, i: Column) -> Column:
            kids = F.concat(*[walk(x[f.name], f.dataType, f.name, depth + 1) for f in inner]) if inner else _none()
            label = x["label"] if "label" in el.fieldNames() else None
            return _with(lambda n: _node("item", lit, i, depth, n, None, label), F.when(x.isNull(), _none()).otherwise(kids))

        got = F.flatten(F.transform(value, element))
    elif isinstance(kind, ArrayType):
        got = F.transform(value, lambda x, i: _node("leaf", lit, i, depth, F.lit(1), None, x))
    else:
        return _none()
    return F.when(value.isNull(), _none()).otherwise(got)


def typed_trees(df: DataFrame, key: str = "record_id", column: str = "exposures") -> DataFrame:
    """(record_id, nodes): the nodes of the nested ``column`` under a record node, one row per row."""
    kids = walk(F.col(column), df.schema[column].dataType, column, 1)
    return df.select(F.col(key).alias("record_id"), _with(lambda n: _node("record", F.lit("record"), F.lit(None), 0, n), kids).alias("nodes"))


_NUMBER = re.compile(r"[+-]?(?:\d+(?:\.\d*)?|\.\d+)(?:[eE][+-]?\d+)?", re.ASCII)


def _no_constant(text: str):
    raise ValueError(text)  # NaN and Infinity are no JSON


def _int(digits: str) -> int | float:
    return int(digits) if len(digits) < 400 else float(digits)


_TOKEN = re.compile(r'[ \t\r\n]*([{}\[\],:]|"(?:[^"\\\x00-\x1f]|\\.)*"|-?(?:0|[1-9]\d*)(?:\.\d+)?(?:[eE][+-]?\d+)?|true|false|null)', re.ASCII)


def _parse_deep(text: str) -> object:
    """JSON by a loop over tokens, whatever the depth; ValueError if it is none."""
    root: list = []
    stack: list = [root]  # open lists and dicts
    keys: list = [None]
    want, at, end = "value", 0, len(text.rstrip(" \t\r\n"))
    while at < end:
        m = _TOKEN.match(text, at)
        if not m or stack[-1] is root and root:
            raise ValueError(at)
        tok, at, top = m[1], m.end(), stack[-1]
        if tok in ",:":
            if tok != want and not (tok == "," and want == "next"):
                raise ValueError(at)
            want = "value" if tok == ":" or isinstance(top, list) else "key"
            continue
        if tok in "]}":
            if want not in ("next", "first value" if tok == "]" else "first key") or isinstance(top, list) != (tok == "]"):
                raise ValueError(at)
            stack.pop()
            keys.pop()
            want = "next"
            continue
        if want.endswith("key"):
            if tok[0] != '"':
                raise ValueError(at)
            keys[-1], want = json.loads(tok), ":"
            continue
        if not want.endswith("value"):
            raise ValueError(at)
        new = [] if tok == "[" else {} if tok == "{" else json.loads(tok, parse_int=_int)
        if isinstance(top, list):
            top.append(new)
        else:
            top[keys[-1]] = new
        want = "next"
        if tok in "[{":
            stack.append(new)
            keys.append(None)
            want = "first value" if tok == "[" else "first key"
    if len(stack) > 1 or not root:
        raise ValueError(at)
    return root[0]


def parse(text: object) -> object:
    """The JSON value of ``text``; None if it is not valid JSON."""
    try:
        return json.loads(text, parse_constant=_no_constant, parse_int=_int)
    except RecursionError:
        try:
            return _parse_deep(text)
        except ValueError:
            return None
    except (ValueError, TypeError):
        return None


def _number(v: object) -> float | None:
    if isinstance(v, bool):
        return None
    try:
        if isinstance(v, (int, float)):
            return float(v)
        if isinstance(v, str) and _NUMBER.fullmatch(v.strip()):
            return float(v)
    except OverflowError:
        return float("inf") if v > 0 else float("-inf")
    return None


def _numbers(v: object) -> list[float]:
    """Numbers of a measure in order: alone or at any depth of a list (no recursion)."""
    out, stack = [], [v]
    while stack:
        x = stack.pop()
        if isinstance(x, list):
            stack.extend(reversed(x))
        elif (n := _number(x)) is not None:
            out.append(n)
    return out


def payload_nodes(payload: object, kind: ArrayType, name: str = "exposures") -> list[tuple]:
    """Nodes (kind, name, ordinal, depth, size, num, text) of one payload, in pre-order: those that
    ``walk`` gives for its ``name`` column of type ``kind``."""

    def node(what: str, label: str | None, ordinal: int | None, depth: int, kids: list, text: object = None, num: float | None = None) -> list[tuple]:
        return [(what, label, ordinal, depth, 1 + len(kids), num, text if isinstance(text, str) else None), *kids]

    def visit(v: object, t: DataType, label: str, depth: int) -> list[tuple]:
        if v is None:
            return []
        if is_measure(t):
            nums = _numbers(v)
            state = "value" if nums else "not_reported" if isinstance(v, str) else "na"
            return node("measure", label, None, depth, [n for i, x in enumerate(nums) for n in node("value", None, i, depth + 1, [], num=x)], state)
        if isinstance(t, StructType):
            return node("block", label, None, depth, fields(v, t, depth + 1)) if isinstance(v, dict) else []
        if isinstance(t, ArrayType) and isinstance(t.elementType, StructType):
            if not isinstance(v, list):
                return []
            return [n for i, x in enumerate(v) for n in node("item", label, i, depth, fields(x, t.elementType, depth + 1) if isinstance(x, dict) else [], x.get("label") if isinstance(x, dict) else None)]
        if isinstance(t, ArrayType):
            return [n for i, x in enumerate(v if isinstance(v, list) else [v]) if isinstance(x, str) for n in node("leaf", label, i, depth, [], x)]
        return []

    def fields(v: dict, t: StructType, depth: int) -> list[tuple]:
        return [n for f in t.fields if isinstance(f.dataType, (StructType, ArrayType)) for n in visit(v.get(f.name), f.dataType, f.name, depth)]

    record = parse(payload)
    if isinstance(record, dict) and isinstance(record.get("record"), dict):
        record = record["record"]
    items = record.get(name) if isinstance(record, dict) else None
    if isinstance(items, str):
        items = parse(items)
    if isinstance(items, dict):
        items = [items]
    return node("record", "record", None, 0, visit(items, kind, name, 1))


def json_trees(df: DataFrame, kind: ArrayType, key: str = "record_id", payload: str = "payload", name: str = "exposures") -> DataFrame:
    """As ``typed_trees``, for records that are JSON texts whose ``name`` has the type ``kind``."""
    fields = ("kind", "name", "ordinal", "depth", "size", "num", "text")

    @F.pandas_udf(f"array<{NODE}>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield pd.Series([[dict(zip(fields, n)) for n in payload_nodes(p, kind, name)] for p in s], dtype=object)

    return df.select(F.col(key).alias("record_id"), run(F.col(payload)).alias("nodes"))


def node_rows(trees: DataFrame) -> DataFrame:
    """(record_id, pre, post, kind, name, ordinal, depth, num, text): one row per node."""
    return trees.select("record_id", F.posexplode("nodes").alias("pre", "n")).select("record_id", "pre", (F.col("pre") - F.col("n.depth") + F.col("n.size") - 1).alias("post"), "n.kind", "n.name", "n.ordinal", "n.depth", "n.num", "n.text")


def inside(nodes: Column, kind: str, base: Column | int = 0, contents: bool = True) -> Column:
    """The nodes of a kind in a slice of a walk that begins at pre number ``base``, in order: STRUCT
    <pre, post, name, ordinal, depth, num, text, below>; below is the slice of what the node contains."""

    def pick(every: Column, n: Column, i: Column) -> Column:
        pre = i + base
        below = [F.slice(every, i + 2, n.size - 1).alias("below")] if contents else []
        return F.when(n.kind == kind, F.struct(pre.alias("pre"), (pre - n.depth + n.size - 1).alias("post"), n["name"].alias("name"), n.ordinal.alias("ordinal"), n.depth.alias("depth"), n.num.alias("num"), n.text.alias("text"), *below))

    return let(nodes, lambda every: F.array_compact(F.transform(every, lambda n, i: pick(every, n, i))))


def children(nodes: Column, depth: Column, base: Column) -> Column:
    """As ``inside``, but the nodes of any kind at one depth, with their kind."""

    def pick(every: Column, n: Column, i: Column) -> Column:
        return F.when(n.depth == depth, F.struct((i + base).alias("pre"), n.kind.alias("kind"), n["name"].alias("name"), n.depth.alias("depth"), F.slice(every, i + 2, n.size - 1).alias("below")))

    return let(nodes, lambda every: F.array_compact(F.transform(every, lambda n, i: pick(every, n, i))))


def holder(nodes: Column, x: Column) -> Column:
    """The innermost of the nodes whose interval contains that of ``x``; null for none."""
    return F.try_element_at(F.filter(nodes, lambda h: (h.pre < x.pre) & (h.post > x.post)), F.lit(-1))


def _each_item(trees: DataFrame, rows: Callable[[Column], Column]) -> DataFrame:
    """(record_id, r): the ``rows(item)`` of every element of ``exposures``. All slicing is inside one
    expression, so a record's nodes are never written to a row before they are rows of a table."""
    items = F.filter(inside(F.col("nodes"), "item"), lambda x: x["name"] == "exposures")
    return trees.select("record_id", F.explode(F.flatten(F.transform(items, rows))).alias("r"))


def single_values(trees: DataFrame, labels: bool = True) -> DataFrame:
    """The table of single numbers, each with the key of its parents; without ``labels`` only that
    key, not the number, its interval and the pre number of its measure."""

    def row(item: Column, block: Column, m: Column, v: Column, i: Column) -> Column:
        pre = m.pre + 1 + i
        more = [v.num.alias("value"), pre.alias("pre"), (pre - v.depth + v.size - 1).alias("post"), m.pre.alias("parent_pre")] if labels else []
        return F.struct(item.ordinal.alias("exposure_no"), block.alias("block"), m["name"].alias("field"), v.ordinal.alias("value_no"), *more)

    def of_measure(item: Column, block: Column, m: Column) -> Column:
        return F.transform(m.below, lambda v, i: row(item, block, m, v, i))  # a measure contains nothing but numbers

    def of_child(item: Column, c: Column) -> Column:
        measures = F.filter(children(c.below, c.depth + 1, c.pre + 1), lambda m: m.kind == "measure")
        nested = F.flatten(F.transform(measures, lambda m: of_measure(item, c["name"], m)))
        return F.when(c.kind == "measure", of_measure(item, F.lit("exposure"), c)).when(c.kind == "block", nested)

    def of_item(item: Column) -> Column:
        full = F.filter(children(item.below, item.depth + 1, item.pre + 1), lambda c: F.size(c.below) > 0)
        return F.flatten(F.array_compact(F.transform(full, lambda c: of_child(item, c))))

    got = _each_item(trees, of_item).select("record_id", "r.*")
    known = reduce(lambda a, c: a | c, [(F.col("block") == b) & F.col("field").isin(*ms) for b, ms in BLOCKS.items()])
    return got.where(known)


def exposures(trees: DataFrame) -> DataFrame:
    """The table of exposures; the parent is the record node, pre 0."""
    got = _each_item(trees, lambda x: F.array(F.struct(x.ordinal.alias("exposure_no"), x.text.alias("label"), x.pre.alias("pre"), x.post.alias("post"), F.lit(0).alias("parent_pre"))))
    return got.select("record_id", "r.*")


def target_terms(trees: DataFrame) -> DataFrame:
    """The table of target terms, each with its exposure."""

    def of_item(item: Column) -> Column:
        row = lambda t, blocks: F.struct(item.ordinal.alias("exposure_no"), t.ordinal.alias("term_no"), t.text.alias("term"), t.pre.alias("pre"), t.post.alias("post"), holder(blocks, t).pre.alias("parent_pre"))
        leaves = F.filter(inside(item.below, "leaf", item.pre + 1, False), lambda t: t["name"] == "terms")
        return let(inside(item.below, "block", item.pre + 1, False), lambda blocks: F.transform(leaves, lambda t: row(t, blocks)))

    return _each_item(trees, of_item).select("record_id", "r.*")


def records(trees: DataFrame) -> DataFrame:
    """The table of records: one row per row of input, with the size of its tree."""
    n = F.size("nodes")
    return trees.select("record_id", F.lit(0).alias("pre"), (n - 1).alias("post"), n.alias("n_nodes"))

"""Finding fields by name anywhere in a JSON document.

A document is searched depth first: an object's own keys come before anything
nested in it, nested containers are visited in order, and null or empty text
never counts as found. Keys are visited alphabetically, which is the order
VARIANT keeps them in and the order canonical JSON writes them in.

``search_fields`` answers most rows without walking the tree:

1. a name among the document's own keys is the answer by definition;
2. for a field still open, one regular expression lists every place in the text
   where one of its names is a key. No place means null; exactly one plain
   scalar is the answer wherever it sits;
3. only the remaining rows pay for the full walk (``tree_hits``), which has no
   depth limit.

Found values are ``struct<text string, literal boolean>``: ``literal`` tells a
JSON number or boolean from a JSON string.

Except for ``search_fields``, the functions take and return SQL expression
text, for use with ``selectExpr`` and ``F.expr``: the expressions bind many
small lambdas, which are far quicker to state than to assemble.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame


FOUND = "struct<text:string,literal:boolean>"
# JSON numbers equal to zero, false and empty containers.
_FALSY = r"^(false|\{\}|\[\]|-?0(\.0*)?([eE].*)?)$"


def quoted(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def name_list(names: Sequence[str]) -> str:
    return ", ".join(quoted(n) for n in sorted(set(names)))


def bind(value: str, use) -> str:
    """``use(name)`` with ``value`` evaluated once, however often the name is used."""
    return f"get(transform(array({value}), b -> {use('b')}), 0)"


def parse(text: str) -> str:
    return f"try_parse_json({text})"


def canonical_json(text: str) -> str:
    """Sorted keys, no blanks, non-ASCII kept; null when the text is not JSON."""
    return f"to_json(try_parse_json({text}))"


def member(doc: str, path: str) -> str:
    """The VARIANT at a path, null where there is none."""
    return f"try_variant_get({doc}, {quoted(path)}, 'variant')"


def entries(doc: str) -> str:
    """Top-level members of an object as a map; null for anything else."""
    return f"try_variant_get({doc}, '$', 'map<string,variant>')"


def items(doc: str) -> str:
    """Elements of a list; null for anything else."""
    return f"try_variant_get({doc}, '$', 'array<variant>')"


def is_object(doc: str) -> str:
    return f"coalesce(startswith(schema_of_variant({doc}), 'OBJECT'), false)"


def is_list(doc: str) -> str:
    return f"coalesce(startswith(schema_of_variant({doc}), 'ARRAY'), false)"


def text_at(doc: str, path: str = "$") -> str:
    """Text at a path: scalars as written, containers as JSON, JSON null as null."""
    return f"try_variant_get({doc}, {quoted(path)}, 'string')"


def found_value(value: str) -> str:
    """Found-value struct of a VARIANT; null for JSON null."""
    both = (
        f"transform(array({value}), v -> named_struct('text', {text_at('v')},"
        " 'literal', schema_of_variant(v) <> 'STRING'))"
    )
    return f"get(filter({both}, f -> f.text is not null), 0)"


def value_at(doc: str, path: str) -> str:
    return found_value(member(doc, path))


def truthy(found: str) -> str:
    """Text of a found value unless it is empty, zero, false or an empty container."""
    test = f"f.text <> '' and not (f.literal and f.text rlike {quoted(_FALSY)})"
    return f"get(filter(array({found}), f -> {test}), 0).text"


def truthy_at(doc: str, *paths: str) -> str:
    """Text of the first path holding a truthy value."""
    return "coalesce(" + ", ".join(truthy(value_at(doc, p)) for p in paths) + ")"


def filled(value: str) -> str:
    """A VARIANT, or null when it is missing, empty, zero or false."""
    return f"get(filter(array({value}), c -> {truthy(found_value('c'))} is not null), 0)"


_NODE = "struct<at:array<int>,parent:array<int>,pos:int,name:string,v:variant>"
_HIT = "struct<parent:array<int>,pos:int,name:string,text:string,literal:boolean>"


def tree_hits(doc: str, text: str, names: Sequence[str]) -> str:
    """Every non-empty value stored under one of ``names``, with its place in the tree.

    Level by level; a document cannot be deeper than its text has opening
    brackets, so that many steps always reach the bottom.
    """

    def hits(nodes: str) -> str:
        picked = f"filter({nodes}, n -> n.name in ({name_list(names)}))"
        shaped = (
            f"transform({picked}, n -> named_struct('parent', n.parent, 'pos', n.pos, 'name', n.name,"
            f" 'text', {text_at('n.v')}, 'literal', schema_of_variant(n.v) <> 'STRING'))"
        )
        return f"filter({shaped}, h -> coalesce(h.text <> '', false))"

    def node(name: str, value: str) -> str:
        return (
            "named_struct('at', concat(n.at, array(i)), 'parent', n.at, 'pos', i,"
            f" 'name', {name}, 'v', {value})"
        )

    members = f"transform(map_entries({entries('n.v')}), (e, i) -> {node('e.key', 'e.value')})"
    elements = f"transform({items('n.v')}, (x, i) -> {node('cast(null as string)', 'x')})"
    below = f"flatten(transform(acc.nodes, n -> coalesce({members}, {elements}, array())))"
    empty = "cast(array() as array<int>)"
    root = f"array(named_struct('at', {empty}, 'parent', {empty}, 'pos', 0, 'name', cast(null as string), 'v', {doc}))"
    start = f"named_struct('nodes', cast({root} as array<{_NODE}>), 'hits', cast(array() as array<{_HIT}>))"
    step = (
        f"named_struct('nodes', cast({below} as array<{_NODE}>),"
        f" 'hits', cast(concat(acc.hits, {hits('acc.nodes')}) as array<{_HIT}>))"
    )
    depth = f"greatest(1, length({text}) - length(translate({text}, '[{{', '')))"
    return f"aggregate(sequence(1, {depth}), {start}, (acc, k) -> {step}, acc -> concat(acc.hits, {hits('acc.nodes')}))"


def first_of(hits: str, names: Sequence[str]) -> str:
    """The first hit, in search order, whose key is one of ``names``.

    Paths compare like words in a dictionary with a prefix first, which is
    exactly own keys before nested ones and siblings in order.
    """
    best = f"array_min(filter({hits}, h -> h.name in ({name_list(names)})))"
    named = f"transform(array({best}), h -> named_struct('text', h.text, 'literal', h.literal))"
    return f"get(filter({named}, f -> f.text is not null), 0)"


def find_first(doc: str, text: str, names: Sequence[str]) -> str:
    """Text of the first value found under one of ``names`` (full walk)."""
    return f"{first_of(tree_hits(doc, text, names), names)}.text"


def texts_at(doc: str, names: Sequence[str]) -> str:
    """Texts of several members of an object in one pass over it; null for anything else.

    No two names may differ by case only.
    """
    kind = "struct<" + ",".join(f"`{n}`:string" for n in names) + ">"
    return f"try_variant_get({doc}, '$', {quoted(kind)})"


def _apart(names: Sequence[str]) -> list[list[str]]:
    """The names in groups without two that differ by case only."""
    groups: list[dict[str, str]] = []
    for name in sorted(set(names)):
        group = next((g for g in groups if name.lower() not in g), None)
        if group is None:
            groups.append(group := {})
        group[name.lower()] = name
    return [list(g.values()) for g in groups]


def own_key(doc: str, texts: Mapping[str, str], names: Sequence[str]) -> str:
    """The value of the first of ``names``, alphabetically, among the document's own keys.

    ``texts`` says where the text of each name is; the type is looked up for the one found only.
    """

    def case(name: str) -> str:
        path = f'$["{name}"]'
        shape = f"schema_of_variant({member(doc, path)}) <> 'STRING'"
        return f"when {texts[name]} <> '' then named_struct('text', {texts[name]}, 'literal', {shape})"

    return "case " + " ".join(case(n) for n in sorted(set(names))) + " end"


def _key_pattern(names: Sequence[str]) -> str:
    return r'[{,]\s*"(?:' + "|".join(sorted(re.escape(n) for n in set(names))) + r')"\s*:'


def mentions(text: str, names: Sequence[str]) -> str:
    """How often any of ``names`` is a key in a JSON text.

    A quote inside a JSON string is always escaped, so a quoted name right
    after an opening brace or comma and before a colon can only be a key.
    """
    return f"coalesce(regexp_count({text}, {quoted(_key_pattern(names))}), 0)"


def fence(df: DataFrame, *passing: str) -> DataFrame:
    """Let no filter on the columns worked out so far slip below the work.

    Pushed down, it would repeat the whole computation of its column, once more
    at every projection it passes. A filter that needs a generator's output
    stays above the generator, here one that makes a single row. Unused columns
    are still pruned, and filters on the plain columns in ``passing`` still reach
    the scan.
    """
    held = df.selectExpr("*", "explode(array(true)) as _held")
    return held.selectExpr(
        *[f"`{c}`" if c in passing else f"if(_held, `{c}`, null) as `{c}`" for c in df.columns]
    )


def search_fields(
    df: DataFrame, doc: str, text: str, fields: Mapping[str, Sequence[str]], leading: str | None = None
) -> DataFrame:
    """Add one found-value column per field, searching the documents in column ``doc``.

    ``text`` is a column with a JSON text of the same document. ``leading`` may
    hold an object of some of the document's members, which are then looked at
    before the others, own keys and nested ones alike. Each step runs only for
    the rows the step before left open, and the columns of a step are plain
    columns of the next, so nothing is worked out twice.
    """
    kept = [f"`{c}`" for c in df.columns]
    every = sorted({n for names in fields.values() for n in names})
    # One pass per object finds the texts of all names.
    spaces = {space: mark for space, mark in ((leading, "_l"), (doc, "_d")) if space}
    groups = list(enumerate(_apart(every)))
    opened = df.selectExpr("*", *[f"{texts_at(space, group)} as {mark}{i}" for space, mark in spaces.items() for i, group in groups])
    texts = {space: {n: f"{mark}{i}.`{n}`" for i, group in groups for n in group} for space, mark in spaces.items()}

    def own(names: Sequence[str]) -> str:
        return f"coalesce({', '.join(own_key(space, texts[space], names) for space in spaces)})"

    owned = opened.selectExpr(*kept, *[f"{own(names)} as _w_{f}" for f, names in fields.items()])
    owns = [f"_w_{f}" for f in fields]
    # Every place a name is a key, with its value if that is a plain scalar and '' if not.
    plain_value = r'\s*("[^"\\]*"|[^\s",}\]\[{]*)'

    def all_places(f: str, names: Sequence[str]) -> str:
        # A plain substring test rules most texts out before the pattern runs.
        seen = " or ".join("contains({}, {})".format(text, quoted(f'"{n}"')) for n in sorted(set(names)))
        every_place = f"regexp_extract_all({text}, {quoted(_key_pattern(names) + plain_value)}, 1)"
        return f"case when _w_{f} is null and ({seen}) then {every_place} end"

    places = [f"{all_places(f, names)} as _a_{f}" for f, names in fields.items()]
    # A key spelled with \u escapes is not seen by the pattern.
    listed = owned.selectExpr("*", f"contains({text}, {quoted(chr(92) + 'u')}) as _escaped", *places)
    only = [f"case when size(_a_{f}) = 1 then get(_a_{f}, 0) end as _o_{f}" for f in fields]
    many = [
        f"_w_{f} is null and coalesce(_escaped or size(_a_{f}) > 1 or (size(_a_{f}) = 1 and get(_a_{f}, 0) = ''), false) as _m_{f}"
        for f in fields
    ]
    judged = listed.selectExpr(*kept, *owns, *only, *many)
    still = " or ".join(f"_m_{f}" for f in fields)
    space = f"if({leading} is null, {doc}, to_variant_object(array({leading}, {doc})))" if leading else doc
    # The list around a leading part is one bracket more than the text shows.
    depth_text = f"concat('[', {text})" if leading else text
    walked = judged.selectExpr("*", f"case when {still} then {tree_hits(space, depth_text, every)} end as _hits")

    def answer(f: str, names: Sequence[str]) -> str:
        raw = f"_o_{f}"
        body = f"if(startswith({raw}, '\"'), substr({raw}, 2, length({raw}) - 2), {text_at(parse(raw))})"
        single = (
            f"case when not _m_{f} and {raw} <> '\"\"' and {raw} <> 'null'"
            f" then named_struct('text', {body}, 'literal', not startswith({raw}, '\"')) end"
        )
        deep = f"case when _m_{f} then {first_of('_hits', names)} end"
        return f"cast(coalesce(_w_{f}, {single}, {deep}) as {FOUND}) as {f}"

    return fence(walked.selectExpr(*kept, *[answer(f, names) for f, names in fields.items()]), *df.columns)



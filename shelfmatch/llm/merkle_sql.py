"""DuckDB SQL for the manifest of ``documents``: every level of both trees written out."""

from __future__ import annotations

import string

UPPER, LOWER = string.ascii_uppercase, string.ascii_lowercase
#: crc32 of the decimal id, byte by byte and bit by bit.
CRC = """xor(4294967295, list_reduce(
  flatten(list_transform(string_split(cast(doc_id as varchar), ''), lambda b: [ascii(b), -1, -1, -1, -1, -1, -1, -1, -1])),
  lambda c, b: case when b >= 0 then xor(c, b) when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, 4294967295::bigint))"""


def field(value: str) -> str:
    return f"coalesce(strlen(cast({value} as varchar)) || ':' || cast({value} as varchar), '-')"


def leaf(text: str) -> str:
    return "sha256(" + " || ".join(map(field, ("doc_id", "source", "lang", "n_chars", text))) + ")"


def level(name: str, n: int, arity: int) -> str:
    """Siblings left and right on level ``n`` and the level above it; a tree that has come to its root stays as it is."""
    run = f"partition by tree, place // {arity} order by place rows between"
    return f"""{name}s{n} as (select *,
  coalesce(string_agg(digest, '') over ({run} unbounded preceding and 1 preceding), '') as l,
  coalesce(string_agg(digest, '') over ({run} 1 following and unbounded following), '') as r from {name}{n}),
{name}{n + 1} as (select tree, place // {arity} as place, (size + {arity - 1}) // {arity} as size, sha256(digest || r) as digest
  from {name}s{n} where size > 1 and place % {arity} = 0 union all select tree, place, size, digest from {name}s{n} where size = 1)"""


def climbed(name: str, first: str, levels: int, arity: int) -> str:
    """Siblings by level: those of the ancestor there, none where the tree has come to its root."""
    joins = " ".join(
        f"join {name}s{n} s{n} on s{n}.tree = t.tree and s{n}.place = t.place // {arity ** n}" for n in range(levels))
    steps = ", ".join(f"case when s{n}.size > 1 then {{'l': s{n}.l, 'r': s{n}.r}} end" for n in range(levels))
    return f"{name}p as (select t.*, list_filter([{steps}], lambda s: s is not null) as steps from {first} t {joins})"


def manifest_sql(levels: int = 12, arity: int = 8) -> str:
    """The documents' levels are ``a0, a1, ...``, those of the subroots ``b0, b1, ...``; ``arity ** levels`` rows at most."""
    lowered = f"translate(text, '{UPPER}', '{LOWER}')"
    ctes = [
        f"""leaves as (select doc_id, coalesce('1' || lang, '0') as tree, {leaf('text')} as leaf, {leaf(lowered)} as low,
  {CRC} % 3 = 0 as altered from documents)""",
        """placed as (select *, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as place,
  count(*) over (partition by tree) as size from leaves)""",
        "a0 as (select tree, place, size, leaf as digest from placed)",
        *[level("a", n, arity) for n in range(levels)],
        f"""subroots as (select '' as tree, row_number() over (order by tree) - 1 as place, count(*) over () as size,
  digest, tree as own from a{levels})""",
        "b0 as (select tree, place, size, digest from subroots)",
        *[level("b", n, arity) for n in range(levels)],
        climbed("a", "placed", levels, arity),
        climbed("b", "subroots", levels, arity),
        f"""told as (select a.doc_id, a.leaf, b.digest as subroot, (select digest from b{levels}) as root,
  case when a.altered then a.low else a.leaf end as own, list_concat(a.steps, b.steps) as steps from ap a join bp b on b.own = a.tree)""",
        """folded as (select *, list_reduce(list_concat([{'l': own, 'r': ''}], steps),
  lambda f, s: {'l': sha256(s.l || f.l || s.r), 'r': ''}).l as folded_root from told)""",
    ]
    return "with " + ",\n".join(ctes) + """
select doc_id, leaf, subroot, root, sha256(coalesce(array_to_string(list_transform(steps, lambda s: s.l || s.r), ''), '')) as proof_sha256,
  folded_root, folded_root = root as verified from folded"""

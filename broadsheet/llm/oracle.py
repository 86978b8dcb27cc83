"""SQL of the operators' queries, for an independent engine over the same tables."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Levels of a tree of the manifest that the SQL writes out: fanout ** levels leaves at most.
FANOUT, LEVELS, TOP_LEVELS = 8, 6, 2


def _crc32(text: str) -> str:
    """CRC-32 of an ASCII text, bit by bit (the reversed polynomial as a number)."""
    return (
        f"xor(4294967295, list_reduce(list_prepend(4294967295::bigint, list_transform(string_split({text}, ''), "
        "lambda c: ascii(c)::bigint)), lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), "
        "lambda h, i: xor(h >> 1, 3988292384 * (h & 1)))))"
    )


def _leaf(text: str) -> str:
    parts = [f"coalesce(strlen({v}::varchar) || ':' || {v}::varchar, '-')" for v in ("doc_id", "source", "lang", "n_chars", text)]
    return f"sha256({' || '.join(parts)})"


def _tree(name: str, leaves: str, levels: int) -> list[str]:
    """CTEs of the levels of the trees of ``leaves(tree, pos, node)`` and of their roots ``{name}_root``."""
    ctes, below = [], leaves
    for k in range(levels):
        ctes.append(f"""{name}{k} as (
  select *, count(*) over (partition by tree) > 1 as rises,
    coalesce(string_agg(node, '') over (run rows between unbounded preceding and 1 preceding), '') as before,
    coalesce(string_agg(node, '') over (run rows between 1 following and unbounded following), '') as after
  from {below} window run as (partition by tree, pos // {FANOUT} order by pos))""")
        ctes.append(f"""{name}{k}_up as (
  select tree, case when rises then pos // {FANOUT} else pos end as pos,
    case when rises then sha256(string_agg(node, '' order by pos)) else min(node) end as node
  from {name}{k} group by tree, rises, case when rises then pos // {FANOUT} else pos end)""")
        below = f"{name}{k}_up"
    ctes.append(f"{name}_root as (select tree, node from {below})")
    return ctes


def _climb(name: str, levels: int, tree: str, pos: str, node: str, proof: str, source: str) -> list[str]:
    """CTEs that take the rows of ``source`` up their tree, gathering the siblings."""
    ctes = []
    for k in range(levels):
        ctes.append(f"""{name}_climb{k} as (
  select s.* exclude ({pos}, {node}, {proof}),
    case when t.rises then s.{pos} // {FANOUT} else s.{pos} end as {pos},
    case when t.rises then sha256(t.before || s.{node} || t.after) else s.{node} end as {node},
    s.{proof} || case when t.rises then t.before || t.after else '' end as {proof}
  from {source} s join {name}{k} t on s.{tree} = t.tree and s.{pos} = t.pos)""")
        source = f"{name}_climb{k}"
    return ctes


def _merkle() -> str:
    tampered = f"case when {_crc32('doc_id::varchar')} % 3 = 0 then translate(text, '{UPPER}', '{LOWER}') else text end"
    ctes = [
        f"""shown as materialized (
  select doc_id, coalesce('=' || lang, '') as tree, {_leaf('text')} as leaf, {_leaf('tampered')} as folded
  from (select *, {tampered} as tampered from documents))""",
        """leaves as (
  select *, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as pos, '' as proof from shown)""",
        "nodes as (select tree, pos, leaf as node from leaves)",
        *_tree("low", "nodes", LEVELS),
        "tops as (select '' as tree, row_number() over (order by tree) - 1 as pos, tree as name, node from low_root)",
        "top_nodes as (select tree, pos, node from tops)",
        *_tree("top", "top_nodes", TOP_LEVELS),
        *_climb("low", LEVELS, "tree", "pos", "folded", "proof", "leaves"),
        f"""joined as (
  select c.doc_id, c.leaf, c.folded, c.proof, t.tree as forest, t.pos as top_at, t.node as subroot
  from low_climb{LEVELS - 1} c join tops t on c.tree = t.name)""",
        *_climb("top", TOP_LEVELS, "forest", "top_at", "folded", "proof", "joined"),
    ]
    return f"""with {''', '''.join(ctes)}
select c.doc_id, c.leaf, c.subroot, r.node as root, sha256(c.proof) as proof_sha256, c.folded as folded_root,
  c.folded = r.node as verified
from top_climb{TOP_LEVELS - 1} c join top_root r on true"""


ORACLE["op11_merkle"] = _merkle()

ORACLE["op12_jaccard"] = rf"""
with recursive words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') as w
  from documents),
sets as materialized (
  select doc_id, case len(w) when 0 then [] when 1 then w when 2 then [w[1] || ' ' || w[2]] else
    list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) end as s
  from words),
grams as materialized (select doc_id, len(s) as n, unnest(s) as g from sets),
shared as materialized (
  select doc_id, n, g from (select *, count(*) over (partition by g) as c from grams) where c > 1),
links as materialized (
  select a.doc_id as a, b.doc_id as b
  from shared a join shared b on a.g = b.g and a.doc_id <> b.doc_id and 100 * a.n >= 90 * b.n and 100 * b.n >= 90 * a.n
  group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 90 * (a.n + b.n - count(*))),
reach as (
  select a, b from links union select r.a, l.b from reach r join links l on r.b = l.a),
least as (select a, least(a, min(b)) as m from reach group by a)
select doc_id, len(s)::bigint as n_shingles, coalesce(m, doc_id) as component_id
from sets left join least on doc_id = a"""


def _repair() -> str:
    """The cheapest edits as the least text of cost, audit and repaired lines, row by row from the end."""
    sep, white = "chr(1)", r"[^\x20\x09-\x0D]"

    def ahead(letter: str, cost: str, rest: str, line: str | None) -> str:
        """``rest`` with an edit in front; null stays null."""
        price = f"lpad((left({rest}, 9)::int + {cost})::varchar, 9, '0')"
        body = f"substr({rest}, 10)"
        if line is None:
            return f"{price} || '{letter}' || {body}"
        more = f"case when ends_with({rest}, {sep}) then '' else chr(10) end"
        return (f"{price} || '{letter}' || split_part({body}, {sep}, 1) || {sep} || {line} || {more} || "
                f"substr({rest}, instr({rest}, {sep}) + 1)")

    def inserted(state: str, values: dict[str, str]) -> str:
        """The least of a state's own value and those that begin with up to two inserts."""
        to, role, after, next_role = {
            "e": ("u", "user", "a", "assistant"), "s": ("u", "user", "a", "assistant"),
            "u": ("a", "assistant", "u", "user"), "a": ("u", "user", "a", "assistant")}[state]
        one = ahead("I", "5", values[to], f"'{role}:'")
        two = ahead("I", "5", f"({ahead('I', '5', values[after], f"'{next_role}:'")})", f"'{role}:'")
        return f"list_min([{values[state]}, {one}, {two}])"

    def stepped(state: str) -> str:
        delete = ahead("D", "2", f"b.{state}", None)
        options = [delete]
        extra = "case when r.fault = 'truncated' then 5 else 0 end"
        good = "r.fault not in ('blank', 'duplicate')"
        for initial, to, role in {"e": [("s", "s", None), ("u", "u", "user")], "s": [("u", "u", "user")],
                                  "u": [("a", "a", "assistant")], "a": [("u", "u", "user")]}[state]:
            keep = ahead("K", extra, f"b.{to}", "r.role || ':' || r.text")
            options.append(f"case when {good} and left(r.role, 1) = '{initial}' then {keep} end")
            if role:
                change = ahead("R", f"1 + {extra}", f"b.{to}", f"'{role}:' || r.text")
                options.append(f"case when {good} then {change} end")
        same = ahead("K", extra, f"b.{state}", "r.role || ':' || r.text")
        options.append(f"case when {good} and r.role = '' then {same} end")
        return f"list_min([{', '.join(options)}]) as {state}"

    start = {"e": f"'000000000' || {sep}", "s": "null", "u": "null", "a": f"'000000000' || {sep}"}
    own = {s: s for s in "esua"}
    return rf"""
with recursive struck as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    {_crc32("coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ')")} % 20 as kind
  from conversations),
damaged as (
  select conv_id, turn, case when kind = 4 then 'user' else role end as role,
    case kind when 1 then '' when 2 then translate(text, '.!?', '') else text end as text,
    unnest(case kind when 3 then [0, 1] else [0] end) as copy
  from struck where kind <> 0),
numbered as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, sha256(text), copy) as i from damaged),
read as materialized (
  select *, case when not regexp_matches(text, '{white}') then 'blank'
      when row_number() over (partition by conv_id, role, text order by i) > 1 then 'duplicate'
      when not regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') then 'truncated' else '' end as fault,
    left(lag(role) over (partition by conv_id order by i), 1) || left(role, 1) as pair,
    count(*) over (partition by conv_id) as n
  from numbered),
best as (
  select conv_id, n + 1 as i, {', '.join(f"{inserted(s, start)} as {s}" for s in 'esua')}
  from (select distinct conv_id, n from read)
  union all
  select conv_id, i, {', '.join(f"{inserted(s, own)} as {s}" for s in 'esua')} from (
    select r.conv_id, r.i, {', '.join(stepped(s) for s in 'esua')}
    from best b join read r on r.conv_id is not distinct from b.conv_id and r.i = b.i - 1)),
found as (select conv_id, e from best where i = 1),
faults as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
    count(*) filter (where fault = 'blank') as blank, count(*) filter (where fault = 'duplicate') as duplicate,
    count(*) filter (where fault = 'truncated') as truncated,
    count(*) filter (where pair is not null and pair not in ('su', 'ua', 'au')) as illegal
  from read group by conv_id),
every as (select distinct conv_id from conversations)
select v.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
  coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, coalesce(left(e, 9)::bigint, 0) as cost,
  coalesce(split_part(substr(e, 10), {sep}, 1), '') as audit,
  sha256(coalesce(substr(e, instr(e, {sep}) + 1), '')) as repaired_sha256
from every v left join faults f on v.conv_id is not distinct from f.conv_id
  left join found g on v.conv_id is not distinct from g.conv_id"""


ORACLE["op13_repair"] = _repair()

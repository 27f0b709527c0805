"""Status vocabulary (team settings text -> (team_id, status_id, label)) and
the label lookup that replaces status ids in the items report.

Settings are YAML text whose keys may be symbols (``:statuses``) or strings.  A
node is the text behind its key (``inline``) and the deeper lines below it; a
key is looked up among the lines of the node's own depth, or among the parts of
a flow collection, so labels are read by path: section, list, entry, id and
label, each through a tag whose data is under ``elements``.  Each entry is a row
of its own, so one that can't be read costs that entry only
(``unreadable_statuses`` lists them, and a section or list of another form).
All of it is Spark's text and array functions, written as SQL.  The join is left to the planner:
the vocabulary is small, so it is broadcast once its real size is known, and
shuffled if there are very many teams.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SECTION, LIST = "media_verification_statuses", "statuses"
#: Plain scalars that are null, and what a letter behind a backslash stands for.
NULLS = ("", "~", "null", "Null", "NULL")
ESCAPES = {"0": "\0", "a": "\a", "b": "\b", "t": "\t", "\t": "\t", "n": "\n", "v": "\v", "f": "\f", "r": "\r", "e": "\x1b",
           "N": "\x85", "_": "\xa0", "L": " ", "P": " "}

_NODE = "struct<inline:string,lines:array<string>>"
_NO_LINES = "cast(array() AS array<string>)"
_QUOTES = r"[\x22\x27]?"


# Each helper takes and gives SQL text; a node is a column of type _NODE.

def _staged(df: DataFrame, **columns: str) -> DataFrame:
    """``df`` with columns that later expressions refer to without being merged with them."""
    return df.selectExpr("*", f"inline(array(named_struct({', '.join(f'{n!r}, {c}' for n, c in columns.items())})))")


def _indent(line: str) -> str:
    return f"(length({line}) - length(ltrim({line})))"


def _real(line: str) -> str:
    """Whether a line has content (no blank line, comment or document mark)."""
    return rf"(trim({line}) <> '' AND NOT rlike({line}, r'^(\s*#|---|\.\.\.|%)'))"


def _first(lines: str) -> str:
    return f"get(filter({lines}, x -> {_real('x')}), 0)"


def _starts(line: str) -> str:
    """Whether a line starts an entry of a list."""
    return f"(startswith(ltrim({line}), '- ') OR trim({line}) = '-')"


def _from(lines: str, at: str) -> str:
    return f"slice({lines}, cast({at} AS int), greatest(size({lines}) - cast({at} AS int) + 1, 0))"


def _node(inline: str, lines: str = _NO_LINES) -> str:
    return f"cast(named_struct('inline', {inline}, 'lines', {lines}) AS {_NODE})"


def _key(mark: str, key: str) -> str:
    return rf"^{_QUOTES}{mark}{key}{_QUOTES}\s*:(?:\s+|$)"


def _flow_parts(node: str) -> str:
    """The parts of a flow collection (``[a, b]`` or ``{k: v}``), split at its own commas; text behind it is left out.

    A fold over the characters keeps the depth, the open quote and the places of the cuts."""
    text = f"concat_ws(' ', {node}.inline, array_join(transform({node}.lines, x -> trim(x)), ' '))"
    quoted, plain = "s.quote <> ''", "s.quote = ''"
    step = rf"""named_struct(
        'depth', s.depth + CASE WHEN {quoted} THEN 0 WHEN c IN ('[', '{{') THEN 1 WHEN c IN (']', '}}') THEN -1 ELSE 0 END,
        'quote', CASE WHEN {quoted} AND NOT s.escaped AND c = s.quote THEN ''
                      WHEN {plain} AND c IN ('\'', '"') AND s.before IN ('[', '{{', ',', ':', '\'') THEN c ELSE s.quote END,
        'escaped', s.quote = '"' AND NOT s.escaped AND c = '\\',
        'before', CASE WHEN trim(c) = '' THEN s.before ELSE c END, 'i', s.i + 1,
        'cuts', CASE WHEN {plain} AND s.depth = 1 AND c IN (',', ']', '}}') THEN concat(s.cuts, array(s.i + 1)) ELSE s.cuts END)"""
    start = "named_struct('depth', 0, 'quote', '', 'escaped', false, 'before', '', 'i', 0, 'cuts', cast(array() AS array<int>))"
    # each part lies between two cuts; the closing bracket is the last
    before = "if(k = 0, 1, s.cuts[k - 1])"
    parts = f"filter(transform(s.cuts, (e, k) -> trim(substring(t, {before} + 1, e - {before} - 1))), p -> p <> '')"
    return f"get(transform(array({text}), t -> aggregate(split(t, ''), {start}, (s, c) -> {step}, s -> {parts})), 0)"


def _in_flow(parts: str, key: str) -> str:
    """The node of a key among the parts of a flow mapping (symbol first), or NULL."""
    def found(mark: str) -> str:
        key_ = _key(mark, key)
        value = _node(f"trim(regexp_replace(p, r'{key_}', ''))")
        return f"get(transform(filter({parts}, p -> rlike(p, r'{key_}')), p -> {value}), 0)"
    return f"coalesce({found(':')}, {found('')})"


def _in_block(node: str, key: str) -> str:
    """The node of a key among the lines of a block mapping (symbol first), or NULL."""
    lines = f"{node}.lines"

    def found(mark: str) -> str:
        at = f"array_position(transform({lines}, x -> {_indent('x')} = base AND rlike(ltrim(x), r'{_key(mark, key)}')), true)"
        ends = f"array_position(transform(b, x -> {_real('x')} AND ({_indent('x')} < base OR ({_indent('x')} = base AND NOT {_starts('x')}))), true)"
        below = f"get(transform(array({_from(lines, 'a + 1')}), b -> get(transform(array({ends}), e -> if(e > 0, slice(b, 1, cast(e - 1 AS int)), b)), 0)), 0)"
        inline = rf"trim(regexp_replace(ltrim(get({lines}, cast(a - 1 AS int))), r'^{_QUOTES}{mark}{key}{_QUOTES}\s*:', ''))"
        return f"get(transform(filter(array({at}), a -> a > 0), a -> {_node(inline, below)}), 0)"
    first = f"get(transform(array({_indent(_first(lines))}), base -> coalesce({found(':')}, {found('')})), 0)"
    return f"CASE WHEN regexp_replace({node}.inline, '^#.*', '') = '' THEN {first} END"


def _child(node: str, key: str) -> str:
    flow = _in_flow("parts", key)
    return (f"CASE WHEN startswith({node}.inline, '{{') THEN get(transform(array({_flow_parts(node)}), parts -> {flow}), 0) "
            f"ELSE {_in_block(node, key)} END")


def _untagged(df: DataFrame, **nodes: str) -> DataFrame:
    """Nodes without their tag or anchor; a tag with instance variables has its block under ``elements``."""
    def tag(c: str) -> str:
        return rf"regexp_extract({c}.inline, r'^((?:[!&]\S*\s*){{0,2}})', 1)"

    def plain(c: str) -> str:
        return f"if({c} IS NULL, null, {_node(f"trim(regexp_replace(substring({c}.inline, length({tag(c)}) + 1), r'^#.*$', ''))", f'{c}.lines')})"

    df = _staged(df, **{f"_{n}": plain(c) for n, c in nodes.items()})
    df = _staged(df, **{f"__{n}": f"CASE WHEN contains({tag(c)}, 'hash-with-ivars') THEN {_in_block(f'_{n}', 'elements')} ELSE _{n} END" for n, c in nodes.items()})
    return _staged(df, **{n: plain(f"__{n}") for n in nodes})


def _list_nodes(teams: DataFrame) -> DataFrame:
    """(team_id, section0, section, list0, list): the section of each team that has one, and its list of statuses, with and without their tags."""
    df = _staged(teams.selectExpr("id AS team_id", "settings"), lines=r"split(regexp_replace(settings, '\\r\\n?', '\n'), '\n')")
    df = _staged(df, header="get(filter(lines, x -> startswith(x, '---')), 0)", first=_first("lines"))
    flow = "startswith(ltrim(first), '{')"
    inline = f"if({flow}, trim(first), coalesce(trim(regexp_replace(header, '^---', '')), ''))"
    df = _staged(df, root0=_node(inline, f"if({flow}, {_from('lines', 'array_position(lines, first) + 1')}, lines)"))
    df = _staged(_untagged(df, root="root0"), section0=_child("root", SECTION))
    df = _staged(_untagged(df, section="section0"), list0=_child("section", LIST))
    return _untagged(df, list="list0").select("team_id", "section0", "section", "list0", "list")


def _entries(lists: DataFrame) -> DataFrame:
    """(team_id, pos, entry, own): the statuses of each team, one node for each, with and without its tag."""
    flow = _staged(lists.where("startswith(list.inline, '[')"), parts=_flow_parts("list"))
    flow = flow.selectExpr("team_id", "posexplode(parts) AS (pos, part)").selectExpr("team_id", "pos + 1 AS pos", f"{_node('part')} AS entry")
    block = _staged(lists.where("list.inline = ''"), first=_first("list.lines")).where(_starts("first"))
    block = _staged(block, dash=_indent("first"))
    starts = f"filter(transform(list.lines, (x, i) -> if({_starts('x')} AND {_indent('x')} = dash, i + 1, null)), i -> i IS NOT NULL)"
    block = _staged(block, starts=f"concat({starts}, array(size(list.lines) + 1))")
    block = block.selectExpr("team_id", "dash", "posexplode(transform(slice(starts, 1, size(starts) - 1), (s, i) -> slice(list.lines, s, starts[i + 1] - s))) AS (pos, lines)")
    block = _staged(block, behind="substring(ltrim(lines[0]), 2)")
    # a mapping may start behind the dash; then its first key stands as deep as the others
    mapping = rf"rlike(trim(behind), r'^{_QUOTES}:?\w[^\[{{]*:(\s|$)')"
    shifted = f"concat(array(concat(repeat(' ', dash + 1), behind)), {_from('lines', '2')})"
    entry = f"if({mapping}, {_node(repr(''), shifted)}, {_node('trim(behind)', _from('lines', '2'))})"
    return _untagged(flow.unionByName(block.selectExpr("team_id", "pos + 1 AS pos", f"{entry} AS entry")), own="entry")


def _folded(text: str) -> str:
    """A line end as a blank, and n blank lines as n line ends."""
    lines = rf"regexp_replace({text}, r'[ \t]*\n[ \t]*', '\n')"
    return rf"regexp_replace(regexp_replace({lines}, r'(?<!\n)\n(?!\n)', ' '), r'\n(\n+)', '$1')"


def _unescaped(text: str) -> str:
    """The text of a double-quoted scalar's inside; NULL for an escape that YAML doesn't know."""
    letters = ", ".join(f"'\\u{ord(k):04x}', '\\u{ord(v):04x}'" for k, v in ESCAPES.items())
    one = rf"""CASE WHEN NOT startswith(p, '\\') THEN p
        WHEN rlike(p, r'^\\[xuU][0-9A-Fa-f]') THEN decode(unhex(lpad(substring(p, 3), 8, '0')), 'UTF-32')
        WHEN substring(p, 2, 1) IN ('"', '\\', '/', ' ') THEN substring(p, 2, 1) ELSE element_at(map({letters}), substring(p, 2, 1)) END"""
    parts = rf"regexp_extract_all({text}, r'(?s)(\\x[0-9A-Fa-f]{{2}}|\\u[0-9A-Fa-f]{{4}}|\\U[0-9A-Fa-f]{{8}}|\\.|[^\\]++)', 1)"
    return f"get(transform(array(transform({parts}, p -> {one})), d -> if(exists(d, p -> p IS NULL), null, array_join(d, ''))), 0)"


_SINGLE = r"(?s)^\x27([^\x27]*+(?:\x27\x27[^\x27]*+)*+)\x27\s*(?:\s#.*)?$"
_DOUBLE = r"(?s)^\x22([^\x22\\]*+(?:\\.[^\x22\\]*+)*+)\x22\s*(?:\s#.*)?$"


def _scalars(df: DataFrame, **nodes: str) -> DataFrame:
    """Scalars without their quotes; NULL for null, block and flow values and for a quote that doesn't close."""
    df = _staged(df, **{f"raw_{n}": rf"regexp_replace(concat_ws('\n', {c}.inline, array_join(transform({c}.lines, x -> trim(x)), '\n')), r'\s+$', '')" for n, c in nodes.items()})
    nulls = ", ".join(map(repr, NULLS))

    def read(raw: str) -> str:
        # a backslash at the end of a line joins it with the next
        double = rf"regexp_replace(regexp_extract({raw}, r'{_DOUBLE}', 1), r'(?<!\\)((?:\\\\)*)\\\n[ \t]*', '$1')"
        single = f"regexp_extract({raw}, r'{_SINGLE}', 1)"
        plain = _folded(rf"regexp_replace({raw}, r'(?s)(^|\s+)#.*$', '')")
        return (rf"CASE WHEN rlike({raw}, r'{_SINGLE}') THEN replace({_folded(single)}, '\'\'', '\'') WHEN rlike({raw}, r'{_DOUBLE}') THEN {_unescaped(_folded(double))} "
                rf"WHEN NOT rlike({raw}, r'^[\[{{|>&*!\x27\x22]') AND {plain} NOT IN ({nulls}) THEN {plain} END")
    return _staged(df, **{n: read(f"raw_{n}") for n in nodes})


def _read(teams: DataFrame) -> DataFrame:
    own = _staged(_entries(_list_nodes(teams)), parts=f"CASE WHEN startswith(own.inline, '{{') THEN {_flow_parts('own')} END")
    own = _staged(own, **{f"{k}0": f"coalesce({_in_flow('parts', k)}, {_in_block('own', k)})" for k in ("id", "label")})
    own = _scalars(_untagged(own, id1="id0", label1="label0"), status_id="id1", status_label="label1")
    return own.select("team_id", "pos", "entry", "status_id", "status_label")


def status_vocabulary(teams: DataFrame) -> DataFrame:
    """(team_id, status_id, status_label), one row per status of each team.
    A later duplicate id of the same team wins, as in a dictionary."""
    read = _read(teams).where(F.col("status_id").isNotNull() & F.col("status_label").isNotNull())
    return read.groupBy("team_id", "status_id").agg(F.max_by("status_label", "pos").alias("status_label"))


def _written(node: str) -> str:
    return rf"trim(BOTH '\n' FROM concat_ws('\n', {node}.inline, array_join({node}.lines, '\n')))"


def _other_lists(teams: DataFrame) -> DataFrame:
    """(team_id, pos 0, entry): a section or list that has a value but is no mapping or list that can be read."""
    nulls = ", ".join(map(repr, NULLS))
    lists = _staged(_list_nodes(teams), first=_first("list.lines"))
    list_lost = f"list IS NULL OR ((list.inline NOT IN ({nulls}) OR first IS NOT NULL) AND NOT (startswith(list.inline, '[') OR (list.inline = '' AND {_starts('first')})))"
    section_lost = f"section0 IS NOT NULL AND (section IS NULL OR (section.inline NOT IN ({nulls}) AND NOT startswith(section.inline, '{{')))"
    lost = lists.where(f"CASE WHEN list0 IS NOT NULL THEN {list_lost} ELSE {section_lost} END")
    return lost.selectExpr("team_id", "0 AS pos", f"if(list0 IS NOT NULL, {_written('list0')}, {_written('section0')}) AS entry")


def listed_statuses(teams: DataFrame) -> DataFrame:
    """(team_id, pos, entry, readable) of every listed status; pos 0 is a whole section or list of another form, never readable."""
    read = _read(teams).selectExpr("team_id", "pos", f"{_written('entry')} AS entry",
                                   "status_id IS NOT NULL AND status_label IS NOT NULL AS readable")
    return read.unionByName(_other_lists(teams).withColumn("readable", F.lit(False)))


def unreadable_statuses(teams: DataFrame) -> DataFrame:
    """(team_id, pos, entry) of listed statuses whose id or label can't be read; pos 0 is a whole section or list of another form."""
    return listed_statuses(teams).where("NOT readable").drop("readable")


def label_statuses(df: DataFrame, vocabulary: DataFrame, team_col: str, status_col: str) -> DataFrame:
    """Replace ``status_col`` by its label (unknown ids and NULL kept), in place."""
    v = vocabulary.select(F.col("team_id").alias("_v_team"), F.col("status_id").alias("_v_id"),
                          F.col("status_label").alias("_v_label"))
    cols = [F.coalesce(F.col("_v_label"), F.col(status_col)).alias(status_col)
            if c == status_col else F.col(f"`{c}`") for c in df.columns]
    joined = df.join(v, (df[team_col] == v["_v_team"]) & (df[status_col] == v["_v_id"]), "left")
    return joined.select(cols)

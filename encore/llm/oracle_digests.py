"""DuckDB twins of the manifest, the prefix trie and the chat format."""

from __future__ import annotations

from encore.llm import chat

_WORDS = r"len(regexp_extract_all({text}, '[^\x20\x09-\x0D]+'))::BIGINT"


def crc32(text: str) -> str:
    """Unsigned CRC-32 of an ASCII string: a byte at a time, a bit at a time."""
    byte = "list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda s, z: xor(s >> 1, 3988292384 * (s & 1)))"
    codes = f"list_concat([4294967295]::BIGINT[], [ord(c)::BIGINT FOR c IN string_split({text}, '')])"
    return f"xor(list_reduce({codes}, lambda a, b: {byte}), 4294967295)"


def op11() -> str:
    def field(value: str) -> str:
        return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen({value}::VARCHAR) || ':' || {value}::VARCHAR END"

    def leaf(text: str) -> str:
        return f"sha256(concat({', '.join(map(field, ['doc_id', 'source', 'lang', 'n_chars', text]))}))"

    folded = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

    def levels(name: str, start: str) -> str:
        return f"""{name}(grp, lvl, place, digest) AS (
  {start}
  UNION ALL
  SELECT grp, lvl + 1, place // 8, sha256(string_agg(digest, '' ORDER BY place))
  FROM (SELECT *, count(*) OVER (PARTITION BY grp) AS n FROM {name}) WHERE n > 1
  GROUP BY grp, lvl, place // 8
)"""

    def runs(name: str, tree: str) -> str:
        return f"""{name} AS (
  SELECT grp, lvl, place // 8 AS run, string_agg(digest, '' ORDER BY place) AS digests
  FROM (SELECT *, count(*) OVER (PARTITION BY grp, lvl) AS n FROM {tree}) WHERE n > 1 GROUP BY ALL
)"""

    def steps(rows: str, place: str, runs: str, grp: str) -> str:
        at = f"({place} // (8 ** {runs}.lvl)::BIGINT)"
        return f"""list({{
    'before': substr({runs}.digests, 1, {at} % 8 * 64), 'digest': '', 'after': substr({runs}.digests, {at} % 8 * 64 + 65)
  }} ORDER BY {runs}.lvl) FILTER ({runs}.lvl IS NOT NULL) AS steps
  FROM {rows} LEFT JOIN {runs} ON {grp} = {runs}.grp AND {at} // 8 = {runs}.run"""

    nothing = "[]::STRUCT(\"before\" VARCHAR, digest VARCHAR, \"after\" VARCHAR)[]"
    return f"""
WITH RECURSIVE leaves AS (
  SELECT row_number() OVER () AS id, doc_id, coalesce('=' || lang, '') AS grp, {leaf('text')} AS leaf,
    CASE WHEN {crc32('doc_id::VARCHAR')} % 3 = 0 THEN {leaf(folded)} ELSE {leaf('text')} END AS given
  FROM documents
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM leaves
), {levels('tree', 'SELECT grp, 0, place, leaf FROM placed')}, tops AS (
  SELECT grp, arg_max(digest, lvl) AS subroot, row_number() OVER (ORDER BY grp) - 1 AS place FROM tree GROUP BY grp
), {levels('upper', "SELECT 'root', 0, place, subroot FROM tops")}, root AS (
  SELECT arg_max(digest, lvl) AS root FROM upper
), {runs('tree_runs', 'tree')}, {runs('upper_runs', 'upper')}, up AS (
  SELECT tops.grp, subroot, {steps('tops', 'tops.place', 'upper_runs', "'root'")} GROUP BY tops.grp, subroot
), low AS (
  SELECT id, doc_id, placed.grp, leaf, given, {steps('placed', 'placed.place', 'tree_runs', 'placed.grp')}
  GROUP BY id, doc_id, placed.grp, leaf, given
), paths AS (
  SELECT doc_id, leaf, given, subroot, root,
    list_concat(coalesce(low.steps, {nothing}), coalesce(up.steps, {nothing})) AS steps
  FROM low JOIN up USING (grp), root
), folded AS (
  SELECT doc_id, leaf, subroot, root,
    sha256(coalesce(array_to_string([s.before || s.after FOR s IN steps], ''), '')) AS proof_sha256,
    list_reduce(
      list_concat([{{'before': '', 'digest': given, 'after': ''}}], steps),
      lambda a, b: {{'before': '', 'digest': sha256(b.before || a.digest || b.after), 'after': ''}}
    ).digest AS folded_root
  FROM paths
)
SELECT *, folded_root = root AS verified FROM folded"""


def op12() -> str:
    words = _WORDS.format(text="steps[depth].text")
    return f"""
WITH own AS (
  SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} ORDER BY turn NULLS FIRST) AS steps
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), heads AS (
  SELECT conv_id, {crc32('conv_id::VARCHAR')} % 4 AS h, steps FROM own
), rebuilt AS (
  SELECT a.conv_id, list_concat(coalesce(b.steps, [])[1:a.h], a.steps[a.h + 1:]) AS steps
  FROM heads a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % 20
), members AS (
  SELECT conv_id, unnest(range(0, len(steps) + 1)) AS depth, steps, len(steps) AS n FROM rebuilt
), prefixes AS (
  SELECT *, steps[1:depth] AS prefix FROM members
), nodes AS (
  SELECT prefix, depth, min(conv_id) AS node, count(*) AS n_convs, max(n) > depth AS goes_on,
    coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = depth), '') AS ends,
    CASE WHEN depth > 0 THEN {words.replace('steps[depth]', 'prefix[depth]')} ELSE 0 END AS words
  FROM prefixes GROUP BY prefix, depth
), parents AS (
  SELECT c.prefix, p.node AS parent FROM nodes c JOIN nodes p ON c.depth = p.depth + 1 AND c.prefix[1:p.depth] = p.prefix
), children AS (
  SELECT p.prefix, count(*) AS n_children
  FROM nodes c JOIN nodes p ON c.depth = p.depth + 1 AND c.prefix[1:p.depth] = p.prefix GROUP BY p.prefix
), subtrees AS (
  SELECT above.prefix, count(*) FILTER (NOT below.goes_on) AS n_leaves, sum((below.n_convs - 1) * below.words)::BIGINT AS saved_tokens
  FROM (SELECT *, unnest(range(0, depth + 1)) AS up FROM nodes) below
  JOIN nodes above ON above.depth = below.up AND below.prefix[1:below.up] = above.prefix
  GROUP BY above.prefix
)
SELECT node AS conv_id, depth, parent AS parent_conv_id, n_convs, coalesce(n_children, 0) AS n_children,
  n_leaves, saved_tokens, sha256(ends) AS ends_sha256
FROM nodes LEFT JOIN parents USING (prefix) LEFT JOIN children USING (prefix) JOIN subtrees USING (prefix)"""


def op13() -> str:
    def escaped(value: str) -> str:
        return f"regexp_replace({value}, '{chat.CONTROL}', '\\1\\\\\\2\\3', 'g')"

    marks = len(chat.TURN) + len(chat.TEXT) + len(chat.END)
    return f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = '{chat.LEARNED}'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST) FILTER (role = '{chat.LEARNED}'), '')) AS loss_sha256,
  sum({marks} + length({escaped('role')}) + length({escaped('text')}))::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id"""


SQL = {
    "op11_merkle_manifest": op11(),
    "op12_prefix_trie": op12(),
    "op13_chat_format": op13(),
}

"""DuckDB counterparts of the trie and of the Merkle manifest."""

from __future__ import annotations

#: CRC-32 of a text of ASCII characters, and the digests' input of one field.
MACROS = {
    "crc": "xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({0}, ''), lambda c: ord(c)::BIGINT)), "
    "lambda s, c: list_reduce(list_prepend(xor(s, c), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), "
    "lambda t, u: xor(t >> 1, (t & 1) * 3988292384))), 4294967295::BIGINT)",
    "field": "coalesce(octet_length(encode(({0})::VARCHAR))::VARCHAR || ':' || ({0})::VARCHAR, '-')",
}


def crc(text: str) -> str:
    return MACROS["crc"].format(text)


def _tree(name: str, start: str, levels: int) -> str:
    """CTEs ``name0 … nameN`` (grp, pos, h, n), level by level; a lone node goes up as it is."""
    out = [f"{name}0 AS (SELECT *, count(*) OVER (PARTITION BY grp) AS n FROM ({start}))"]
    for k in range(levels):
        out.append(
            f"{name}{k + 1} AS (SELECT *, count(*) OVER (PARTITION BY grp) AS n FROM (SELECT grp, pos // 16 AS pos, "
            f"CASE WHEN max(n) = 1 THEN max(h) ELSE sha256(string_agg(h, '' ORDER BY pos)) END AS h FROM {name}{k} GROUP BY grp, pos // 16))"
        )
    return ",\n".join(out)


def _beside(name: str, k: int) -> str:
    """Siblings to the left and right of every node of a level."""
    run = "PARTITION BY grp, pos // 16 ORDER BY pos ROWS BETWEEN"
    return (
        f"{name}s{k} AS (SELECT grp, pos, CASE WHEN n = 1 THEN '' ELSE coalesce(string_agg(h, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') END AS l, "
        f"CASE WHEN n = 1 THEN '' ELSE coalesce(string_agg(h, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') END AS r, n FROM {name}{k})"
    )


def merkle_sql(levels: int = 4) -> str:
    """For at most 16 to the power of ``levels`` rows a source, and as many sources."""
    parts = "doc_id", "source", "lang", "n_chars"
    leaf = "sha256(" + " || ".join(MACROS["field"].format(x) for x in parts) + " || " + MACROS["field"].format("text") + ")"
    small = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    changed = "sha256(" + " || ".join(MACROS["field"].format(x) for x in parts) + " || " + MACROS["field"].format(small) + ")"
    fold, siblings, joins = "f0", "''", ""
    steps = [("a", k) for k in range(levels)] + [("b", k) for k in range(levels)]
    for i, (name, k) in enumerate(steps):
        at = f"d.pos // {16**k}" if name == "a" else f"d.spos // {16**k}"
        same = "s{0}.grp IS NOT DISTINCT FROM d.source AND ".format(i) if name == "a" else ""
        joins += f"\nJOIN {name}s{k} s{i} ON {same}s{i}.pos = {at}"
        siblings += f" || s{i}.l || s{i}.r"
    columns = ", ".join(f"s{i}.l AS l{i}, s{i}.r AS r{i}, s{i}.n AS n{i}" for i in range(len(steps)))
    folds = ""
    for i in range(len(steps)):
        folds += f",\ng{i} AS (SELECT *, CASE WHEN n{i} = 1 THEN f{i} ELSE sha256(l{i} || f{i} || r{i}) END AS f{i + 1} FROM {'met' if i == 0 else f'g{i - 1}'})"
    fold = f"f{len(steps)}"
    return (
        f"WITH leaves AS (SELECT doc_id, source, {leaf} AS leaf, CASE WHEN {crc('doc_id::VARCHAR')} % 5 = 0 THEN {changed} ELSE {leaf} END AS f0, "
        "row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST) - 1 AS pos FROM documents),\n"
        + _tree("a", "SELECT source AS grp, pos, leaf AS h FROM leaves", levels)
        + ",\n" + ",\n".join(_beside("a", k) for k in range(levels))
        + f",\ntops AS (SELECT grp AS source, h AS subroot, row_number() OVER (ORDER BY grp NULLS FIRST) - 1 AS spos FROM a{levels}),\n"
        + _tree("b", "SELECT 0 AS grp, spos AS pos, subroot AS h FROM tops", levels)
        + ",\n" + ",\n".join(_beside("b", k) for k in range(levels))
        + f",\nd AS (SELECT leaves.*, tops.subroot, tops.spos, (SELECT h FROM b{levels}) AS root FROM leaves JOIN tops ON leaves.source IS NOT DISTINCT FROM tops.source),\n"
        + f"met AS (SELECT d.*, sha256({siblings}) AS proof_sha256, {columns} FROM d{joins})" + folds
        + f"\nSELECT doc_id, leaf, subroot, root, proof_sha256, {fold} AS folded_root, {fold} = root AS verified FROM g{len(steps) - 1}"
    )


def trie_sql() -> str:
    words = "len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'))"
    return f"""WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS pos FROM conversations WHERE conv_id IS NOT NULL),
    c AS (SELECT conv_id, list(struct_pack(role := role, text := text, words := {words}) ORDER BY pos) AS own FROM t GROUP BY conv_id),
    h AS (SELECT conv_id, own, (({crc('conv_id::VARCHAR')}) % 4)::BIGINT AS h FROM c),
    r AS (SELECT h.conv_id, list_concat(coalesce(list_slice(d.own, 1, h.h), []), list_slice(h.own, h.h + 1, len(h.own))) AS turns
          FROM h LEFT JOIN c d ON d.conv_id = h.conv_id - h.conv_id % 20),
    p AS (SELECT conv_id, len(turns) AS total, turns, unnest(range(len(turns) + 1)) AS depth FROM r),
    m AS (SELECT conv_id, total, depth, list_slice(turns, 1, depth) AS prefix FROM p),
    n AS (SELECT prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
          sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (total = depth), '')) AS ends_sha256,
          CASE WHEN depth = 0 THEN 0 ELSE (count(*) - 1) * max(prefix[depth].words) END AS saved,
          (count(*) FILTER (total = depth) = count(*))::BIGINT AS leaf FROM m GROUP BY prefix, depth),
    e AS (SELECT prefix, depth, saved, leaf, unnest(range(depth + 1)) AS up FROM n),
    s AS (SELECT list_slice(prefix, 1, up) AS prefix, sum(saved)::BIGINT AS saved_tokens, sum(leaf)::BIGINT AS n_leaves,
          (count(*) FILTER (depth = up + 1))::BIGINT AS n_children FROM e GROUP BY 1)
    SELECT n.conv_id, n.depth::BIGINT AS depth, q.conv_id AS parent_conv_id, n.n_convs, s.n_children, s.n_leaves, s.saved_tokens, n.ends_sha256
    FROM n JOIN s ON s.prefix = n.prefix LEFT JOIN n q ON n.depth > 0 AND q.depth = n.depth - 1 AND q.prefix = list_slice(n.prefix, 1, n.depth - 1)"""

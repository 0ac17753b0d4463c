"""SQL counterparts of the queries that SQL can express."""

from __future__ import annotations

_NGRAM_JACCARD = r"""
WITH RECURSIVE texts AS (
    SELECT doc_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS shingle
    FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 2))) AS i FROM texts WHERE len(words) > 0)
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
    FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id
), linked AS (
    SELECT a, b FROM links JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * common >= 80 * (x.n + y.n - common)
), reach(doc_id, other) AS (
    SELECT doc_id, doc_id FROM documents
    UNION
    SELECT reach.doc_id, linked.b FROM reach JOIN linked ON linked.a = reach.other
)
SELECT reach.doc_id, coalesce(any_value(sizes.n), 0) AS n_shingles, min(reach.other) AS component_id
FROM reach LEFT JOIN sizes ON sizes.doc_id = reach.doc_id
GROUP BY reach.doc_id
"""


_EXACT_DEDUP = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
    row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM (
    SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
    FROM documents
)
WINDOW same AS (PARTITION BY t)
"""


def _crc32(text: str) -> str:
    """CRC-32 of a text of ASCII characters, bit by bit."""
    eight = "CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END"
    byte = f"list_reduce([0, 1, 2, 3, 4, 5, 6, 7], lambda a, i: {eight}, xor(c, b))"
    codes = f"list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT)"
    return f"xor(list_reduce({codes}, lambda c, b: {byte}, 4294967295::BIGINT), 4294967295)"


_CONVERSATION_TRIE = f"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations WHERE conv_id IS NOT NULL
), own AS (
    SELECT conv_id, list(strlen(role)::VARCHAR || ':' || role || text ORDER BY turn NULLS FIRST, sha256(strlen(role)::VARCHAR || ':' || role || text)) AS turns,
        {_crc32("conv_id::VARCHAR")} % 9 AS h
    FROM turns GROUP BY conv_id
), forked AS (
    SELECT own.conv_id, list_concat(coalesce(base.turns[1:own.h], []), own.turns[own.h + 1:]) AS turns
    FROM own LEFT JOIN own base ON base.conv_id = own.conv_id - own.conv_id % 5
), members AS (
    SELECT conv_id, d, turns[1:d] AS path, len(turns) = d AS ended
    FROM (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS d FROM forked)
), sizes AS (
    SELECT DISTINCT strlen(role)::VARCHAR || ':' || role || text AS turn, strlen(text) AS bytes FROM turns
), nodes AS (
    SELECT path, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
        coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ended), '') AS ends
    FROM members GROUP BY path
), children AS (
    SELECT path[1:depth - 1] AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1
), weighed AS (
    SELECT nodes.path, depth, (n_convs - 1) * coalesce(bytes, 0) AS saved, (children.n IS NULL)::INT AS leaf
    FROM nodes LEFT JOIN children ON children.path = nodes.path
    LEFT JOIN sizes ON depth > 0 AND sizes.turn = nodes.path[depth]
), below AS (
    SELECT path[1:a] AS path, sum(leaf)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens
    FROM (SELECT path, saved, leaf, unnest(range(0, depth + 1)) AS a FROM weighed) GROUP BY 1
)
SELECT nodes.conv_id, nodes.depth, parent.conv_id AS parent_conv_id, nodes.n_convs, coalesce(children.n, 0) AS n_children,
    n_leaves, saved_tokens, sha256(nodes.ends) AS ends_sha256
FROM nodes JOIN below ON below.path = nodes.path
LEFT JOIN children ON children.path = nodes.path
LEFT JOIN nodes parent ON nodes.depth > 0 AND parent.path = nodes.path[1:nodes.depth - 1]
"""

#: Levels written out for the trees of langs, and for the tree over them: a million leaves, 256 langs.
_TREE_LEVELS, _HEAD_LEVELS = 20, 8


def _levels(name: str, start: str, levels: int) -> str:
    """Nodes ``tree, pos, n, digest`` of each level of binary trees."""
    out = [f"{name}0 AS MATERIALIZED ({start})"]
    for k in range(levels):
        out.append(f"""{name}{k + 1} AS MATERIALIZED (
    SELECT tree, pos // 2 AS pos, (any_value(n) + 1) // 2 AS n,
        CASE WHEN any_value(n) > 1 THEN sha256(string_agg(digest, '' ORDER BY pos)) ELSE any_value(digest) END AS digest
    FROM {name}{k} GROUP BY tree, pos // 2
)""")
    return ", ".join(out)


def _folds(name: str, nodes: str, start: str, levels: int) -> str:
    """``row, tree, pos, n, digest, proof`` of each leaf on its way up."""
    out = [f"{name}0 AS MATERIALIZED ({start})"]
    for k in range(levels):
        out.append(f"""{name}{k + 1} AS MATERIALIZED (
    SELECT f.row, f.tree, f.pos // 2 AS pos, (f.n + 1) // 2 AS n, f.proof || coalesce(s.digest, '') AS proof,
        CASE WHEN f.n = 1 THEN f.digest WHEN s.digest IS NULL THEN sha256(f.digest)
            WHEN f.pos % 2 = 0 THEN sha256(f.digest || s.digest) ELSE sha256(s.digest || f.digest) END AS digest
    FROM {name}{k} f LEFT JOIN {nodes}{k} s ON s.tree = f.tree AND s.pos = xor(f.pos, 1)
)""")
    return ", ".join(out)


def _merkle_manifest() -> str:
    def field(value: str) -> str:
        return f"coalesce(strlen(({value})::VARCHAR)::VARCHAR || ':' || ({value})::VARCHAR, '-')"

    def leaf(chars: str) -> str:
        return "sha256(" + " || ".join(field(v) for v in ("doc_id", "source", "lang", chars, "text")) + ")"

    return f"""
WITH hashed AS (
    SELECT doc_id, lang, {leaf("n_chars")} AS leaf,
        CASE WHEN doc_id IS NOT NULL AND {_crc32("coalesce(doc_id::VARCHAR, '0')")} % 7 = 0 THEN {leaf("n_chars::HUGEINT + 1")} ELSE {leaf("n_chars")} END AS changed
    FROM documents
), leaves AS MATERIALIZED (
    SELECT *, row_number() OVER () AS row, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
        count(*) OVER (PARTITION BY lang) AS n, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree
    FROM hashed
), {_levels("node", "SELECT tree, pos, n, leaf AS digest FROM leaves", _TREE_LEVELS)},
{_levels("head", f"SELECT 0 AS tree, tree AS pos, (SELECT count(*) FROM node{_TREE_LEVELS}) AS n, digest FROM node{_TREE_LEVELS}", _HEAD_LEVELS)},
{_folds("fold", "node", "SELECT row, tree, pos, n, changed AS digest, '' AS proof FROM leaves", _TREE_LEVELS)},
{_folds("up", "head", f"SELECT row, 0 AS tree, tree AS pos, (SELECT count(*) FROM head0) AS n, digest, proof FROM fold{_TREE_LEVELS}", _HEAD_LEVELS)}
SELECT leaves.doc_id, leaves.leaf, sub.digest AS subroot, root.digest AS root, sha256(up{_HEAD_LEVELS}.proof) AS proof_sha256,
    up{_HEAD_LEVELS}.digest AS folded_root, up{_HEAD_LEVELS}.digest = root.digest AS verified
FROM leaves JOIN up{_HEAD_LEVELS} USING (row)
JOIN node{_TREE_LEVELS} sub ON sub.tree = leaves.tree
JOIN head{_HEAD_LEVELS} root ON root.pos = 0
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op6_ngram_jaccard": _NGRAM_JACCARD,
        "op11_exact_dedup": _EXACT_DEDUP,
        "op12_conversation_trie": _CONVERSATION_TRIE,
        "op13_merkle_manifest": _merkle_manifest(),
    }

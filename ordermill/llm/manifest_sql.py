"""The SQL twin of the manifest query: levels of sixteen as chained tables."""

from __future__ import annotations

# Levels that the twin has; a source may have 16^4 rows, and there may be 16^2 sources.
SOURCE_LEVELS, TOP_LEVELS = 4, 2


def _leaf(text: str) -> str:
    fields = ["doc_id", "source", "lang", "n_chars", text]
    return "sha256(" + " || ".join(f"coalesce(strlen(CAST({f} AS VARCHAR)) || ':' || CAST({f} AS VARCHAR), '-')" for f in fields) + ")"


def _crc32(digits: str) -> str:
    """CRC-32 by its polynomial, a bit at a time."""
    step = "lambda c, i: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END)"
    byte = f"list_reduce(list_prepend(xor(crc, code), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), {step})"
    return f"""xor(list_reduce(list_prepend(4294967295, list_transform(string_split({digits}, ''), lambda d: ascii(d)::BIGINT)),
      lambda crc, code: {byte}), 4294967295)"""


def _levels(prefix: str, tree: str, first: str, levels: int) -> list[str]:
    """Tables prefix0, prefix1, ... of (tree, pos, digest), and prefix_run0, ... of (tree, up, digests)."""
    tables = [f"{prefix}0 AS ({first})"]
    for level in range(levels):
        tables.append(
            f"{prefix}_run{level} AS (SELECT {tree}, pos // 16 AS up, list(digest ORDER BY pos) AS digests, count(*) OVER (PARTITION BY {tree}) = 1"
            f" AND count(*) = 1 AS alone FROM {prefix}{level} GROUP BY {tree}, pos // 16)"
        )
        tables.append(
            f"{prefix}{level + 1} AS (SELECT {tree}, up AS pos, CASE WHEN alone THEN digests[1] ELSE sha256(array_to_string(digests, '')) END AS digest"
            f" FROM {prefix}_run{level})"
        )
    return tables


def _walk(name: str, before: str, prefix: str, tree: str, levels: int) -> tuple[list[str], str]:
    """Tables that fold each leaf's hash up ``levels``, noting the siblings on the way."""
    tables = []
    for level in range(levels):
        left, right = "array_to_string(digests[1:place % 16], '')", "array_to_string(digests[place % 16 + 2:], '')"
        tables.append(
            f"{name}{level} AS (SELECT w.doc_id, w.leaf, w.number, w.tree, place // 16 AS place,"
            f" CASE WHEN alone THEN proof ELSE proof || {left} || {right} END AS proof,"
            f" CASE WHEN alone THEN acc ELSE sha256({left} || acc || {right}) END AS acc"
            f" FROM {before} w JOIN {prefix}_run{level} r ON w.{tree} = r.{tree} AND place // 16 = r.up)"
        )
        before = f"{name}{level}"
    return tables, before


def manifest_sql() -> str:
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    ranked = "row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos"
    tables = [
        f"leaves AS (SELECT doc_id, source, {_leaf('text')} AS leaf, {_leaf(lowered)} AS low, {_crc32('CAST(doc_id AS VARCHAR)')} AS crc FROM documents)",
        f"placed AS (SELECT *, {ranked} FROM leaves)",
        "sources AS (SELECT source, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS number FROM (SELECT DISTINCT source FROM leaves))",
        "numbered AS (SELECT p.*, number FROM placed p JOIN sources s ON p.source IS NOT DISTINCT FROM s.source)",
        *_levels("own", "number", "SELECT number, pos, leaf AS digest FROM numbered", SOURCE_LEVELS),
        *_levels("top", "tree", f"SELECT 0 AS tree, number AS pos, digest FROM own{SOURCE_LEVELS}", TOP_LEVELS),
        "start AS (SELECT doc_id, leaf, number, 0 AS tree, pos AS place, '' AS proof, CASE WHEN crc % 5 = 0 THEN low ELSE leaf END AS acc FROM numbered)",
    ]
    walked, last = _walk("up", "start", "own", "number", SOURCE_LEVELS)
    tables += [*walked, f"across AS (SELECT * REPLACE (number AS place) FROM {last})"]
    walked, last = _walk("over", "across", "top", "tree", TOP_LEVELS)
    body = ",\n".join([*tables, *walked])
    return f"""WITH {body}
SELECT doc_id, leaf, own.digest AS subroot, top.digest AS root, sha256(proof) AS proof_sha256, acc AS folded_root, acc = top.digest AS verified
FROM {last} w JOIN own{SOURCE_LEVELS} own ON w.number = own.number CROSS JOIN top{TOP_LEVELS} top"""

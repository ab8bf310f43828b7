"""Merkle dataset manifest over concatenated-level strings (operator 13)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from foldmill.llm.store import settle
from foldmill.operators.ranking import with_index

ARITY = 2      # consecutive nodes that are hashed into one
DEPTH = 8      # levels of one aligned block, which so has at most ARITY ** DEPTH nodes
HEX = 64       # hex digits of a digest
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

# Sort keys of languages: a null one sorts first, all others bytewise.
NO_LANG = ""
ALL = ""


def digest(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of the parts, one after the other."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field_text(value: Column) -> Column:
    """``-`` for null, else the length in UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(**fields: Column) -> Column:
    return digest(*(field_text(fields[name]) for name in FIELDS))


def _next_level(level: Column, arity: int) -> Column:
    """The string of the parents of a level: every run of ``arity`` digests hashed."""
    width = HEX * arity
    runs = F.ceil(F.length(level) / width).cast("int")
    return F.array_join(F.transform(
        F.sequence(F.lit(0), runs - 1),
        lambda run: F.sha2(F.substring(level, run * width + 1, F.lit(width)).cast("binary"), 256)), "")


def _levels(bottom: Column, height: Column, arity: int) -> Column:
    """Strings of the levels 0 to ``height``. Each is built from the one before it, held in the
    fold's own array, so none is hashed twice."""
    return F.aggregate(
        F.sequence(F.lit(1), F.greatest(height, F.lit(1))), F.array(bottom),
        lambda done, level: F.when(level <= height, F.concat(done, F.array(
            _next_level(F.element_at(done, -1), arity)))).otherwise(done))


def _flanks(levels: Column, place: Column, height: Column, arity: int) -> Column:
    """Per level below ``height``: the siblings left and right of the node on the way up from
    ``place``, as two segments of the level's string. A run at the end of a level may be short;
    the string ends there, and so does the segment."""
    def of(level: Column) -> Column:
        node = F.floor(place / F.pow(F.lit(float(arity)), level.cast("double"))).cast("int")
        start = (F.floor(node / arity) * arity).cast("int")
        text = F.element_at(levels, level + 1)
        return F.struct(
            F.substring(text, start * HEX + 1, (node - start) * HEX).alias("left"),
            F.substring(text, (node + 1) * HEX + 1, (start + arity - 1 - node) * HEX).alias("right"))

    none = F.array().cast("array<struct<left:string,right:string>>")
    return F.when(height > 0, F.transform(F.sequence(F.lit(0), F.greatest(height, F.lit(1)) - 1), of)
                  ).otherwise(none)


def _blocks(nodes: DataFrame, width: int) -> DataFrame:
    """``key, block, rows``: nodes ``key, idx, row`` in aligned blocks of ``width`` neighbours.

    A block has at most ``width`` nodes, so what is collected is bounded. ``row`` begins with the
    digest.
    """
    return (nodes.groupBy("key", F.floor(F.col("idx") / width).alias("block"))
            .agg(F.array_sort(F.collect_list(F.struct("idx", "row"))).alias("rows")))


def _hashed(nodes: DataFrame, arity: int, depth: int) -> DataFrame:
    """Blocks ``key, block, rows, last, height, levels``: ``last`` tells the only block of its key,
    ``height`` how many levels are built above the bottom, ``levels`` are the strings of all.

    A block among others is carried up all ``depth`` levels, a lone node being hashed by itself;
    an only block ends at one node.
    """
    width = arity ** depth
    number = nodes.groupBy("key").agg((F.max("idx") < width).alias("last"))
    size = F.size("rows")
    only = F.lit(depth)
    for level in range(depth - 1, -1, -1):
        only = F.when(size <= arity ** level, F.lit(level)).otherwise(only)
    bottom = F.array_join(F.transform("rows", lambda r: r["row"]["digest"]), "")
    return (_blocks(nodes, width).join(number, "key")
            .withColumn("height", F.when(F.col("last"), only).otherwise(F.lit(depth)))
            .withColumn("levels", _levels(bottom, F.col("height"), arity)))


NO_PATH = "array<struct<left:string,right:string>>"


def _trees(nodes: DataFrame, arity: int, depth: int) -> DataFrame:
    """The blocks of the nodes ``key, idx, row`` with ``top``, the root of their key, and ``path``,
    the siblings at every level from the block's root up to it.

    The blocks' roots are nodes of the same kind, so they recurse until each key has one block.
    On the way back a block learns its path from its parent's block; only block rows are
    joined, ``arity ** depth`` times fewer than nodes at each step.
    """
    blocks = settle(_hashed(nodes, arity, depth))
    root = F.element_at("levels", -1)
    done = blocks.filter("last").select("*", root.alias("top"), F.array().cast(NO_PATH).alias("path"))
    several = blocks.filter("not last")
    if several.isEmpty():
        return done
    upper = _trees(several.select("key", F.col("block").alias("idx"), F.struct(root.alias("digest")).alias("row")),
                   arity, depth)
    upper = _opened(upper, arity, depth).select("key", F.col("idx").alias("block"), "top", "path")
    return done.unionByName(several.join(upper, ["key", "block"]))


def _opened(trees: DataFrame, arity: int, depth: int) -> DataFrame:
    """``key, idx, row, top, path``: the nodes of the blocks, each with its path to the root."""
    found = F.transform("rows", lambda r: F.struct(
        r["idx"].alias("idx"), r["row"].alias("row"),
        _flanks(F.col("levels"), F.pmod(r["idx"], F.lit(arity ** depth)).cast("int"), F.col("height"),
                arity).alias("own")))
    return trees.select("key", "top", "path", F.explode(found).alias("node")).select(
        "key", "node.idx", "node.row", "top", F.concat("node.own", "path").alias("path"))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(path, leaf, lambda below, level: digest(level["left"], below, level["right"]))


def path_text(path: Column) -> Column:
    """All siblings, level by level, left to right."""
    return F.array_join(F.transform(path, lambda level: F.concat(level["left"], level["right"])), "")


def manifest(docs: DataFrame, tampered: dict[str, Column] | None = None, arity: int = ARITY,
             depth: int = DEPTH) -> DataFrame:
    """Merkle tree over the rows of ``docs``, one subtree per language, and a proof per row.

    A leaf is the digest of the columns ``FIELDS``. The leaves of a language ascend by doc_id;
    every ``arity`` consecutive nodes become one, until one is left, the subroot. The subroots,
    ordered by language, become the root in the same way. ``tampered`` replaces columns for the check:
    the root is computed again from the changed leaf and the siblings of the true one.

    Leaves are numbered by ``with_index``, which spreads one large language over many ranges. An
    aligned block of ``arity ** depth`` leaves then keeps each level as one string of digests
    of 64 digits: parents are hashes of fixed-width substrings, siblings are the substrings beside a node.

    Returns per row of ``docs``: doc_id, lang, leaf, subroot, root, path (an array of left and
    right siblings from the leaf up), proof_sha256 (of all siblings), folded_root and verified.
    Nulls in any column have their own text, so null and empty differ. A null language is a
    language of its own and the first; null doc_ids come first. Rows that share an id are ordered by their leaf;
    equal rows give equal leaves, each with a place of its own. A text may be of any length. An
    empty table gives no rows. Other columns are ignored. ``n_chars`` at its greatest value
    becomes null when 1 is added.
    """
    have = {name: F.col(f"`{name}`") for name in FIELDS}
    leaf = leaf_digest(**have)
    false = leaf_digest(**{**have, **(tampered or {})})
    key = F.coalesce(F.concat(F.lit("="), "lang"), F.lit(NO_LANG))
    # Stored, since sorting by range reads its input twice and texts shall be hashed once.
    marked = settle(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", key.alias("key"),
                                leaf.alias("digest"), false.alias("false_digest")))
    placed = with_index(marked, ["key"], ["doc_id", "digest"])
    nodes = placed.select("key", "idx", F.struct("digest", "doc_id", "lang", "false_digest").alias("row"))
    trees = _trees(nodes, arity, depth)
    subroots = trees.filter("block = 0").select("key", F.struct(F.col("top").alias("digest")).alias("row"))
    # One node per language: a tree like the others, of a single key.
    listed = with_index(subroots, [], ["key"]).select(
        F.lit(ALL).alias("key"), "idx", F.struct("row.digest", F.col("key").alias("lang_key")).alias("row"))
    above = _opened(_trees(listed, arity, depth), arity, depth).select(
        F.col("row.lang_key").alias("key"), F.col("top").alias("root"), F.col("path").alias("upper"))
    leaves = _opened(trees, arity, depth)
    whole = leaves.join(above, "key").withColumn("path", F.concat("path", "upper"))
    return whole.select(
        "row.doc_id", "row.lang", F.col("row.digest").alias("leaf"), F.col("top").alias("subroot"), "root", "path",
        F.sha2(path_text(F.col("path")).cast("binary"), 256).alias("proof_sha256"),
        fold(F.col("row.false_digest"), F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def _crc32_sql(text: str) -> str:
    """Unsigned CRC-32 of ASCII digits, bit by bit."""
    bits = ("list_reduce(list_prepend({0}, [CAST(b AS BIGINT) FOR b IN range(8)]), "
            "lambda c, b: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)")
    step = bits.format("xor(h, CAST(ord(d) AS BIGINT))")
    return (f"xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), "
            f"list_transform(string_split({text}, ''), lambda s: CAST(ord(s) AS BIGINT))), "
            f"lambda h, d: {step.replace('CAST(ord(d) AS BIGINT)', 'd')}))")


SQL_LEVELS = 22   # levels that the SQL states; a language has fewer than 2 ** 22 rows there


def _tree_sql(name: str, levels: int) -> list[str]:
    """Common table expressions ``name_0`` (k, i, h) up to the roots, for pairs of nodes."""
    steps = []
    for n in range(1, levels + 1):
        below = f"{name}_{n - 1}"
        steps.append(f"""{name}_{n} AS MATERIALIZED (SELECT k, i // 2 AS i, sha256(string_agg(h, '' ORDER BY i)) AS h
            FROM (SELECT *, count(*) OVER (PARTITION BY k) AS n FROM {below}) AS t WHERE n > 1 GROUP BY k, i // 2)""")
    every = " UNION ALL ".join(f"SELECT {n} AS l, * FROM {name}_{n}" for n in range(levels + 1))
    steps.append(f"{name} AS MATERIALIZED ({every})")
    steps.append(f"""{name}_top AS MATERIALIZED (SELECT k, max(l) AS l, arg_max(h, l) AS h FROM {name} GROUP BY k)""")
    return steps


def manifest_sql(levels: int = SQL_LEVELS) -> str:
    """The same in SQL, with rows tampered whose id's CRC-32 is a multiple of 7."""
    shown = lambda x: f"coalesce(strlen(CAST({x} AS VARCHAR)) || ':' || CAST({x} AS VARCHAR), '-')"
    leaf = lambda n: "sha256(" + " || ".join(shown(x) for x in ("doc_id", "source", "lang", n, "text")) + ")"
    crc = _crc32_sql("CAST(doc_id AS VARCHAR)")
    steps = [f"""d AS MATERIALIZED (SELECT doc_id, coalesce('=' || lang, '') AS k, {leaf('n_chars')} AS leaf,
            CASE WHEN {crc} % 7 = 0 THEN {leaf('n_chars + 1')} ELSE {leaf('n_chars')} END AS bad FROM documents)""",
             """placed AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p
            FROM d)""",
             "low_0 AS MATERIALIZED (SELECT k, p AS i, leaf AS h FROM placed)", *_tree_sql("low", levels),
             """high_0 AS MATERIALIZED (SELECT '' AS k, row_number() OVER (ORDER BY encode(k)) - 1 AS i, h FROM low_top)""",
             *_tree_sql("high", 8),
             """langs AS MATERIALIZED (SELECT k, row_number() OVER (ORDER BY encode(k)) - 1 AS g FROM low_top)""",
             """at_0 AS MATERIALIZED (SELECT doc_id, k, p, leaf, t.h AS subroot, g, (SELECT h FROM high_top) AS root,
            bad AS folded, '' AS proof FROM placed JOIN low_top t USING (k) JOIN langs USING (k))"""]
    last = "at_0"
    for tree, place, key, n in [("low", "p", "a.k", levels), ("high", "g", "''", 8)]:
        for level in range(n):
            node = f"({place} // {1 << level})"
            steps.append(f"""{tree}_at_{level} AS MATERIALIZED (SELECT a.* EXCLUDE (folded, proof),
                CASE WHEN {level} >= e.l THEN folded WHEN {node} % 2 = 1 THEN sha256(s.h || folded)
                     ELSE sha256(folded || coalesce(s.h, '')) END AS folded,
                CASE WHEN {level} >= e.l THEN proof ELSE proof || coalesce(s.h, '') END AS proof
                FROM {last} a JOIN {tree}_top e ON e.k = {key}
                LEFT JOIN {tree} s ON s.k = {key} AND s.l = {level} AND s.i = xor({node}, 1))""")
            last = f"{tree}_at_{level}"
    return f"""WITH {", ".join(steps)}
        SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root,
            folded = root AS verified FROM {last}"""

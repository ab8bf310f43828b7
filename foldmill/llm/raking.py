"""Mixing sources to target weights by iterative proportional fitting (operator 1)."""

from __future__ import annotations

import logging
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from foldmill.llm.store import settle
from foldmill.operators.keys import is_small

log = logging.getLogger(__name__)

ROUNDS = 60           # of fitting, each over all margins, at most
TEMPERATURE = 0.7     # exponent that flattens the shares of today into targets
KEEP = 0.5            # share of all tokens to expect in the sample
TOLERANCE = 1e-6      # tokens by which a fitted margin may miss, as a share of all to expect
EXACT = 1e-13         # the same where a round costs no job
SQL_ROUNDS = 30       # that the SQL states; the fit has settled by then
SEED = 17
ROWS_PER_FILE = 200_000   # of cells; a margin has no more categories than there are cells
NONE = "(none)"       # category of a null
MARGINS = ("source", "lang", "topic")

WORD = r"[^\x20\x09-\x0D]+"


def token_weight(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("double")


def topic_of(text: Column) -> Column:
    """A coarse topic read off the text itself; callers with better topics give their own."""
    return (F.when(text.contains("icense") | text.contains("ights reserved"), "notice")
            .when(text.contains("|"), "table").when(text.contains("%%%"), "marked")
            .when(F.length(text) >= 4000, "long").when(F.length(text) >= 500, "prose")
            .otherwise("brief"))


def draw(doc_id: Column, seed: int = SEED) -> Column:
    """A number from 0 to 1 that depends on the id alone."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def _files(cells: DataFrame) -> int:
    """Files for a table of so many rows, instead of one per shuffle partition."""
    return max(1, -(-cells.count() // ROWS_PER_FILE))


def _targets(cells: DataFrame, name: str, given: DataFrame | None,
             temperature: float) -> DataFrame:
    """``name, target``: the share of all tokens that each category shall have."""
    now = cells.groupBy(name).agg(F.sum("tokens").alias("tokens"))
    if given is None:
        now = now.withColumn("wish", F.pow("tokens", F.lit(temperature)))
    else:
        wish = given.groupBy(F.coalesce(name, F.lit(NONE)).alias(name)).agg(F.max("share").alias("wish"))
        now = now.join(wish, name, "left").na.fill(0.0, ["wish"])
    total = now.agg(F.sum("wish")).first()[0]
    share = F.col("wish") / F.lit(total) if total else F.lit(0.0)
    return settle(now.select(name, share.alias("target")).repartition(_files(cells)))


def _goals(cells: DataFrame, targets: dict[str, DataFrame], keep: float) -> dict[str, DataFrame]:
    """``name, goal``: the tokens to expect of each category, for every margin.

    They follow the targets, but a category has no more than all of its tokens; what it lacks
    goes to the others in proportion. All margins have the same sum, ``keep`` of all tokens or
    what the categories with a target have.
    """
    wished = {}
    budget = keep * (cells.agg(F.sum("tokens")).first()[0] or 0.0)
    for name, target in targets.items():
        now = cells.groupBy(name).agg(F.sum("tokens").alias("tokens"))
        wished[name] = settle(now.join(target, name).repartition(_files(cells)))
        budget = min(budget, wished[name].filter("target > 0").agg(F.sum("tokens")).first()[0] or 0.0)
    goals = {}
    for name, wish in wished.items():
        scale, full, before = budget, F.lit(False), -1
        while True:
            found = wish.agg(F.count(F.when(full, 1)).alias("full"),
                             F.sum(F.when(full, F.col("tokens")).otherwise(0.0)).alias("whole"),
                             F.sum(F.when(full, 0.0).otherwise(F.col("target"))).alias("rest")).first()
            if found["full"] == before or not found["rest"]:
                break
            before, scale = found["full"], (budget - found["whole"]) / found["rest"]
            full = full | (F.col("target") * F.lit(scale) >= F.col("tokens"))
        goals[name] = wish.select(name, F.when(full, F.col("tokens")).otherwise(
            F.col("target") * F.lit(scale)).alias("goal"))
    return goals


def bounded(cells: DataFrame, targets: dict[str, DataFrame], keep: float = KEEP,
            rounds: int = ROUNDS) -> DataFrame:
    """Adds ``weight``, a product of one factor per category of every margin, and ``probability``,
    ``keep`` times the weight and at most 1, so that the margins of tokens times probability are
    ``keep`` of all tokens dealt out by the targets.

    The margins are fitted in turn: cells at 1 are fixed and the others of a category share what
    is left, until all margins hold within ``TOLERANCE``, or for ``rounds`` where no
    probabilities meet them all. A category that is to have more than all of its tokens is
    taken whole. The cells stay as they are; each step is one partial aggregation over
    them and rewrites the factors of one margin. ``missed`` is the most by which a margin is off, as a share of
    all tokens to expect. For cells of any number; ``fit_cells`` does the same for few.
    """
    names = list(targets)
    files = _files(cells)
    goals = {n: settle(g.repartition(files)) for n, g in _goals(cells, targets, keep).items()}
    expected = goals[names[0]].agg(F.sum("goal")).first()[0] or 0.0
    factors = {n: goals[n].select(n, F.lit(1.0).alias(f"of_{n}")) for n in names}
    left = F.col("goal") - F.col("whole")
    step = (F.when((F.col("rest") > 0) & (left > 0), left / F.col("rest"))
            .when(F.col("whole") + F.col("rest") > 0, F.col("goal") / (F.col("whole") + F.col("rest")))
            .otherwise(1.0))

    def chances() -> DataFrame:
        joined = reduce(lambda df, n: df.join(factors[n].select(n, f"of_{n}"), n), names, cells)
        return joined.withColumn("weight", reduce(
            lambda x, n: x * F.col(f"of_{n}"), names, F.lit(1.0))).withColumn("chance", F.col("weight") * F.lit(keep))

    missed = 0.0
    for _ in range(rounds):
        missed = 0.0
        for name in names:
            full = F.col("chance") >= 1
            sums = chances().groupBy(name).agg(
                F.sum(F.when(full, F.col("tokens")).otherwise(0.0)).alias("whole"),
                F.sum(F.when(full, 0.0).otherwise(F.col("tokens") * F.col("chance"))).alias("rest"))
            own = F.col(f"of_{name}") * step
            factors[name] = settle(
                goals[name].join(sums, name).join(factors[name].select(name, f"of_{name}"), name)
                .select(name, F.greatest(F.lit(1e-60), F.least(F.lit(1e60), own)).alias(f"of_{name}"),
                        F.abs(left - F.col("rest")).alias("missed")).repartition(files))
            missed = max(missed, factors[name].agg(F.max("missed")).first()[0] or 0.0)
        if missed <= TOLERANCE * expected:
            break
    return chances().select(*cells.columns, "weight", F.least(F.lit(1.0), F.col("chance")).alias("probability"),
                            F.lit(missed / expected if expected else 0.0).alias("missed"))


def _goal(now: np.ndarray, share: np.ndarray, budget: float) -> np.ndarray:
    """Tokens to expect per category: ``budget`` dealt out by ``share``, none above its own."""
    scale, full = budget, np.zeros(len(now), bool)
    while True:
        more = full | (share * scale >= now)
        if np.array_equal(more, full) or not share[~more].sum():
            return np.where(more, now, share * scale)
        full = more
        scale = (budget - now[full].sum()) / share[~full].sum()


def fit_cells(tokens: np.ndarray, codes: list[np.ndarray], shares: list[np.ndarray],
              keep: float = KEEP, rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """Weights of the cells as ``bounded`` fits them, and the most by which a margin is off.

    ``codes`` are the cells' categories per margin, ``shares`` the target of each category.
    """
    now = [np.bincount(c, tokens, len(s)) for c, s in zip(codes, shares)]
    budget = min([keep * tokens.sum()] + [n[s > 0].sum() for n, s in zip(now, shares)])
    goals = [_goal(n, s, budget) for n, s in zip(now, shares)]
    factors = [np.ones(len(s)) for s in shares]
    off = 0.0
    for _ in range(rounds):
        off = 0.0
        for code, goal, factor in zip(codes, goals, factors):
            chance = keep * np.prod([f[c] for f, c in zip(factors, codes)], axis=0)
            full = chance >= 1
            whole = np.bincount(code, np.where(full, tokens, 0.0), len(goal))
            rest = np.bincount(code, np.where(full, 0.0, tokens * chance), len(goal))
            left = goal - whole
            step = np.where((rest > 0) & (left > 0), left / np.where(rest > 0, rest, 1.0),
                            np.where(whole + rest > 0, goal / np.where(whole + rest > 0, whole + rest, 1.0), 1.0))
            factor[:] = np.clip(factor * step, 1e-60, 1e60)
            off = max(off, np.abs(left - rest).max(initial=0.0) / max(goal.sum(), 1e-300))
        if off <= EXACT:
            break
    return np.prod([f[c] for f, c in zip(factors, codes)], axis=0), off


_CELL = "source string, lang string, topic string, tokens double"
_FITTED = _CELL + ", weight double, probability double, missed double, " + ", ".join(
    f"target_{n} double" for n in MARGINS)


def _fit_small(cells: DataFrame, wishes: DataFrame, given: set[str], temperature: float, keep: float,
               rounds: int) -> DataFrame:
    """``bounded`` in one task, for cells that were counted: a round costs no job there."""
    def fit(rows: pa.Table, asked: pa.Table) -> pa.Table:
        tokens = rows.column("tokens").to_numpy()
        asked = list(zip(*(asked.column(n).to_pylist() for n in ("margin", "category", "share"))))
        codes, shares = [], []
        for name in MARGINS:
            categories, code = np.unique(np.array(rows.column(name).to_pylist(), object), return_inverse=True)
            if name in given:
                wish = {c: s for m, c, s in asked if m == name}
                share = np.array([wish.get(c) or 0.0 for c in categories], float)
            else:
                share = np.bincount(code, tokens, len(categories)) ** temperature
            codes.append(code)
            shares.append(share / share.sum() if share.sum() else share)
        weight, missed = fit_cells(tokens, codes, shares, keep, rounds)
        found = {n: rows.column(n) for n in (*MARGINS, "tokens")}
        found |= {"weight": weight, "probability": np.minimum(1.0, keep * weight),
                  "missed": np.full(len(weight), missed)}
        return pa.table(found | {f"target_{n}": s[c] for n, s, c in zip(MARGINS, shares, codes)})

    one = F.lit(0).alias("all")
    return (cells.select(one, *MARGINS, "tokens").groupBy("all")
            .cogroup(wishes.select(one, "margin", "category", "share").groupBy("all"))
            .applyInArrow(lambda a, b: fit(a, b) if a.num_rows else _nothing(_FITTED), _FITTED))


def _nothing(schema: str) -> pa.Table:
    kinds = {"string": pa.string(), "double": pa.float64()}
    return pa.table({n: pa.array([], kinds[k]) for n, k in (f.split() for f in schema.split(", "))})


def _fitted(docs: DataFrame, topic: Column | None, targets: dict[str, DataFrame] | None,
            temperature: float, keep: float, rounds: int,
            in_one_task: bool | None = None) -> tuple[dict[str, Column], DataFrame, bool]:
    """Category columns of a document, the cells with weight, probability and the target of each of
    their categories, and whether these are few. Without ``in_one_task`` their size decides."""
    targets = targets or {}
    key = {"source": F.coalesce("source", F.lit(NONE)), "lang": F.coalesce("lang", F.lit(NONE)),
           "topic": F.coalesce(topic_of(F.col("text")) if topic is None else topic, F.lit(NONE))}
    cells = settle(docs.select(token_weight(F.col("text")).alias("tokens"),
                               *(c.alias(n) for n, c in key.items()))
                   .groupBy(*MARGINS).agg(F.sum("tokens").alias("tokens")))
    small = is_small(cells)
    if small if in_one_task is None else in_one_task:
        spark = docs.sparkSession
        # Only categories that occur, so no more rows than the cells have.
        asked = [targets[n].select(F.lit(n).alias("margin"), F.coalesce(n, F.lit(NONE)).alias("category"), "share")
                 .join(cells.select(F.col(n).alias("category")).distinct(), "category")
                 .groupBy("margin", "category").agg(F.max("share").cast("double").alias("share")) for n in targets]
        wishes = reduce(DataFrame.unionByName, asked) if asked else spark.createDataFrame(
            [], "margin string, category string, share double")
        fitted = settle(_fit_small(cells, wishes, set(targets), temperature, keep, rounds))
    else:
        cells = settle(cells.repartition(_files(cells)))
        wishes = {n: _targets(cells, n, targets.get(n), temperature) for n in MARGINS}
        fitted = settle(reduce(lambda df, n: df.join(wishes[n].withColumnRenamed("target", f"target_{n}"), n),
                               MARGINS, bounded(cells, wishes, keep, rounds)))
    missed = fitted.agg(F.max("missed")).first()[0] or 0.0
    if missed > TOLERANCE:
        log.warning("Targets are missed by up to %.2g of the expected tokens.", missed)
    return key, fitted, small


def expected_margins(docs: DataFrame, topic: Column | None = None,
                     targets: dict[str, DataFrame] | None = None, temperature: float = TEMPERATURE,
                     keep: float = KEEP, rounds: int = ROUNDS) -> DataFrame:
    """What ``mix`` with the same arguments expects: a row per category of every margin.

    Columns margin, category, target and expected (shares of all expected tokens), and met:
    false where no sample of that size has tokens enough to follow the target.
    """
    _, chances, _ = _fitted(docs, topic, targets, temperature, keep, rounds)
    total = chances.agg(F.sum(F.col("tokens") * F.col("probability"))).first()[0] or 0.0
    share = F.col("expected") / F.lit(total) if total else F.lit(0.0)
    return reduce(DataFrame.unionByName, (
        chances.groupBy(n).agg(F.sum(F.col("tokens") * F.col("probability")).alias("expected"),
                               F.max(f"target_{n}").alias("target"))
        .select(F.lit(n).alias("margin"), F.col(n).alias("category"), "target", share.alias("expected"))
        .withColumn("met", F.abs(F.col("expected") - F.col("target")) <= 10 * TOLERANCE)
        for n in MARGINS))


def mix(docs: DataFrame, topic: Column | None = None, targets: dict[str, DataFrame] | None = None,
        temperature: float = TEMPERATURE, keep: float = KEEP, rounds: int = ROUNDS,
        seed: int = SEED) -> DataFrame:
    """A sample of the documents whose tokens follow target shares of source, language and topic.

    ``targets`` may give a table (category, ``share``) per margin, ``source``, ``lang`` or
    ``topic``; a category it lacks gets nothing. Without one, a margin's target is its present
    shares to the power ``temperature``, made to sum to 1. Tokens are counted per cell of the three
    margins, probabilities of at most 1 are fitted to them in turn (``bounded``), and each document
    is taken with its cell's probability. Cells that are few, by a count, are fitted in one task,
    without a job per step; others by jobs over all cells. Targets that are missed are logged,
    ``expected_margins`` tells which.

    Returns the rows taken, all their columns, and mix_weight and mix_probability (columns of
    these names are replaced). Null source, lang or topic are a category of their own. Null and
    empty texts have no tokens: they are taken with their cell's probability and change no
    target. Repeated rows of one id are taken together. A null id counts as an empty one.
    """
    key, chances, small = _fitted(docs, topic, targets, temperature, keep, rounds)
    chances = chances.select(
        *(F.col(n).alias(f"_mix_{n}") for n in MARGINS), F.col("weight").alias("_mix_weight"),
        F.col("probability").alias("_mix_probability"))
    chances = F.broadcast(chances) if small else chances
    marked = docs.drop("mix_weight", "mix_probability").withColumns(
        {f"_mix_{n}": c for n, c in key.items()})
    return (marked.join(chances, [f"_mix_{n}" for n in MARGINS])
            .filter(draw(F.col("doc_id"), seed) < F.col("_mix_probability"))
            .withColumnsRenamed({"_mix_weight": "mix_weight", "_mix_probability": "mix_probability"})
            .drop(*(f"_mix_{n}" for n in MARGINS)))


def mix_sql(rounds: int = SQL_ROUNDS, temperature: float = TEMPERATURE, keep: float = KEEP,
            seed: int = SEED) -> str:
    """The same in SQL: one common table expression per step of the fit.

    A goal is found in as many steps as categories can be cut off one after the other; eight do.
    """
    steps = [f"""d AS MATERIALIZED (SELECT doc_id, coalesce(source, '{NONE}') AS source, coalesce(lang, '{NONE}') AS lang,
        CASE WHEN contains(text, 'icense') OR contains(text, 'ights reserved') THEN 'notice'
             WHEN contains(text, '|') THEN 'table' WHEN contains(text, '%%%') THEN 'marked'
             WHEN length(text) >= 4000 THEN 'long' WHEN length(text) >= 500 THEN 'prose'
             ELSE 'brief' END AS topic,
        CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS DOUBLE) AS tokens FROM documents)""",
             """cells AS MATERIALIZED (SELECT source, lang, topic, sum(tokens) AS tokens FROM d
        GROUP BY source, lang, topic)""",
             f"""budget AS MATERIALIZED (SELECT {keep} * sum(tokens) AS tokens FROM cells)"""]
    for name in MARGINS:
        steps.append(f"""{name}_goal_0 AS MATERIALIZED (SELECT {name}, now, pow(now, {temperature}) /
            (sum(pow(now, {temperature})) OVER ()) AS share, false AS whole, (SELECT tokens FROM budget) AS scale
            FROM (SELECT {name}, sum(tokens) AS now FROM cells GROUP BY {name}) AS t)""")
        for n in range(1, 9):
            steps.append(f"""{name}_goal_{n} AS MATERIALIZED (SELECT {name}, now, share, whole, coalesce(
                ((SELECT tokens FROM budget) - coalesce(sum(now) FILTER (whole) OVER (), 0))
                / nullif(sum(share) FILTER (NOT whole) OVER (), 0), scale) AS scale
                FROM (SELECT * REPLACE (whole OR share * scale >= now AS whole) FROM {name}_goal_{n - 1}) AS t)""")
        steps.append(f"""{name}_goal AS MATERIALIZED (SELECT {name},
            CASE WHEN whole THEN now ELSE share * scale END AS goal FROM {name}_goal_8)""")
        steps.append(f"{name}_0 AS (SELECT {name}, CAST(1.0 AS DOUBLE) AS f FROM {name}_goal)")
    last = {n: f"{n}_0" for n in MARGINS}
    for r in range(1, rounds + 1):
        for name in MARGINS:
            chances = f"""SELECT cells.*, {keep} * source_f.f * lang_f.f * topic_f.f AS p FROM cells
                JOIN {last['source']} source_f USING (source) JOIN {last['lang']} lang_f USING (lang)
                JOIN {last['topic']} topic_f USING (topic)"""
            steps.append(f"""{name}_{r} AS MATERIALIZED (SELECT {name}, f * CASE
                WHEN rest > 0 AND goal > whole THEN (goal - whole) / rest
                WHEN whole + rest > 0 THEN goal / (whole + rest) ELSE 1.0 END AS f
                FROM {last[name]} JOIN {name}_goal USING ({name}) JOIN (SELECT {name},
                    sum(CASE WHEN p >= 1 THEN tokens ELSE 0.0 END) AS whole,
                    sum(CASE WHEN p >= 1 THEN 0.0 ELSE tokens * p END) AS rest
                    FROM ({chances}) AS c GROUP BY {name}) AS s USING ({name}))""")
            last[name] = f"{name}_{r}"
    steps.append(f"""chances AS (SELECT source, lang, topic, a.f * b.f * c.f AS weight,
        least(1.0, {keep} * a.f * b.f * c.f) AS probability
        FROM cells JOIN {last['source']} a USING (source) JOIN {last['lang']} b USING (lang)
        JOIN {last['topic']} c USING (topic))""")
    return f"""WITH {", ".join(steps)}
        SELECT doc_id, source, lang, topic, CAST(tokens AS BIGINT) AS n_tokens, round(weight, 6) AS weight,
               round(probability, 6) AS probability
        FROM d JOIN chances USING (source, lang, topic)
        WHERE CAST(('0x' || substr(md5('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13)) AS BIGINT)
              / {float(1 << 52)} < probability"""

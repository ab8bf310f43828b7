"""Chat formatting with offset-aligned loss masks (operator 3)."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer, pre_tokenizers

TURN = "### "          # before a role
ROLE_END = ":\n"       # between role and text
TEXT_END = "</turn>\n"
LOSS_ROLES = ("assistant",)
# Characters of rendered conversations that are encoded together.
CHUNK = 4_000_000

OUT = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
       "formatted_chars long, n_tokens long, n_loss_tokens long, formatted string, "
       "loss_mask array<boolean>")


def escaped(text: str) -> str:
    """Breaks up control strings by a backslash behind their first character."""
    return re.sub(r"#(?=##)|<(?=/turn>)", r"\g<0>\\", text.replace("\\", "\\\\"))


def escaped_role(role: str) -> str:
    return escaped(role).replace(":", "\\:").replace("\n", "\\\n")


def unescaped(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def render(turns: Sequence[tuple[str, str]]) -> str:
    return "".join(f"{TURN}{escaped_role(role)}{ROLE_END}{escaped(text)}{TEXT_END}"
                   for role, text in turns)


_READ = re.compile(r"### ((?:\\.|[^\\:])*):\n(.*?)</turn>\n", re.DOTALL)


def spans(formatted: str) -> list[tuple[str, int, int]]:
    """Role, and first and last place of the text, of every turn of a rendered conversation."""
    return [(unescaped(m[1]), m.start(2), m.end(2)) for m in _READ.finditer(formatted)]


def intersections(starts: np.ndarray, ends: np.ndarray, token_starts: np.ndarray,
                  token_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which tokens meet one of the sorted spans ``[start, end)``, and which characters both hold.

    The first span that ends behind the token's start is found by binary search; as spans are
    sorted and apart, the token meets some span only if it meets that one or later ones.
    """
    first = np.searchsorted(ends, token_starts, "right")
    last = np.searchsorted(starts, token_ends, "left")
    meets = (first < last) & (token_ends > token_starts)
    size = int(max(ends.max(initial=0), token_ends.max(initial=0)))
    depth = np.zeros(size + 1, np.int64)
    np.add.at(depth, token_starts[meets], 1)
    np.add.at(depth, token_ends[meets], -1)
    inside = np.zeros(size + 1, np.int64)
    np.add.at(inside, starts, 1)
    np.add.at(inside, ends, -1)
    return meets, (np.cumsum(depth) > 0) & (np.cumsum(inside) > 0)


def format_conversations(turns: DataFrame, tokenizer_file: str | None = None,
                         loss_roles: Sequence[str] = LOSS_ROLES) -> DataFrame:
    """Renders, encodes and masks whole conversations.

    ``turns`` has conv_id, turn, role, text. A conversation's turns are put in order of turn
    (ties: role, then text), rendered with control strings in roles and texts escaped, and encoded
    once. The spans of the texts of ``loss_roles`` are intersected with the token offsets by
    binary search; a token that runs over a border counts with the part inside.

    Returns per conversation: formatted, loss_mask (one per token), n_tokens, n_loss_tokens, and,
    read back from these: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    Null role or text: empty. Null turn: before all others. Null conv_id: one conversation of its
    own. Repeated rows are turns of their own. No rows: no rows. Other columns are ignored. A
    conversation is one row of the result, so its turns do come together in one task.
    """
    tokenizer_file = tokenizer_file or public_tokenizers.path("byte_bpe_50k.json")
    roles = frozenset(loss_roles)

    def encode(batches: Iterator[pa.RecordBatch]):
        tokenizer = Tokenizer.from_file(tokenizer_file)
        tokenizer.encode_special_tokens = True
        # Offsets then cover the space that a token begins with.
        tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, trim_offsets=False)
        for batch in batches:
            ids = batch.column("conv_id")
            waiting: list[str] = []
            begin = 0
            for row, turns_of in enumerate(batch.column("turns")):
                waiting.append(render([(t["role"] or "", t["text"] or "") for t in turns_of.as_py()]))
                if sum(map(len, waiting)) >= CHUNK or row + 1 == batch.num_rows:
                    yield _formatted(ids.slice(begin, len(waiting)), waiting, tokenizer, roles)
                    begin, waiting = row + 1, []

    gathered = (turns.select("conv_id", F.struct(
        F.col("turn").cast("long").alias("turn"), "role", "text").alias("turns"))
        .groupBy(F.col("conv_id").cast("long").alias("conv_id"))
        .agg(F.array_sort(F.collect_list("turns")).alias("turns")))
    return gathered.mapInArrow(encode, OUT)


def _formatted(ids: pa.Array, rendered: list[str], tokenizer: Tokenizer,
               roles: frozenset[str]) -> pa.RecordBatch:
    out = {field.split()[0]: [] for field in OUT.split(", ")}
    for formatted, encoding in zip(rendered, tokenizer.encode_batch(rendered, add_special_tokens=False)):
        found = spans(formatted)
        loss = np.array([(a, b) for role, a, b in found if role in roles and b > a],
                        np.int64).reshape(-1, 2)
        offsets = np.array(encoding.offsets, np.int64).reshape(-1, 2)
        mask, chars = intersections(loss[:, 0], loss[:, 1], offsets[:, 0], offsets[:, 1])
        edges = np.flatnonzero(np.diff(np.concatenate([[0], chars.astype(np.int8), [0]])))
        text = "".join(unescaped(formatted[a:b]) for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()))
        seen = hashlib.sha256("".join(f"{role}\n{unescaped(formatted[a:b])}\n"
                                      for role, a, b in found).encode()).hexdigest()
        for name, value in (("n_turns", len(found)), ("turns_sha256", seen), ("loss_chars", len(text)),
                            ("loss_sha256", hashlib.sha256(text.encode()).hexdigest()),
                            ("formatted_chars", len(formatted)), ("n_tokens", len(mask)),
                            ("n_loss_tokens", int(mask.sum())), ("formatted", formatted),
                            ("loss_mask", mask.tolist())):
            out[name].append(value)
    out["conv_id"] = ids
    kinds = {"loss_mask": pa.list_(pa.bool_())}
    return pa.RecordBatch.from_arrays(
        [pa.array(out[n], kinds.get(n, pa.string() if n in ("turns_sha256", "loss_sha256", "formatted")
                                    else pa.int64())) if n != "conv_id" else ids
         for n in out], list(out))

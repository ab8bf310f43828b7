"""Scorers and the sequence shuffle: the Python that runs inside Spark tasks."""

from __future__ import annotations

import hashlib
import json
import os
import re
import shutil
import signal
import subprocess
import sys
import threading
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np

from foldmill.fixed_values import MFE_LINE_PATTERN
from foldmill.operators.walks import shuffle_all

# Pair energies of the stand-in model, in whole units per base pair.
PAIR_ENERGY = {"GC": -3, "AU": -2, "GU": -1}
MIN_LOOP = 3


class LetterGraph:
    """Shuffles of one sequence, each from a random stream of its own. See ``walks`` for many."""

    def __init__(self, seq: str):
        self.seq = seq

    def shuffles(self, rngs: Sequence[np.random.Generator]) -> Iterator[str]:
        seeds = [_bits(rng) for rng in rngs]
        yield from shuffle_all([self.seq], [0] * len(seeds), seeds)

    def shuffle(self, rng: np.random.Generator) -> str:
        return next(self.shuffles([rng]))


def dinucleotide_shuffle(seq: str, rng: np.random.Generator) -> str:
    return LetterGraph(seq).shuffle(rng)


def iteration_rng(seed: int, name: str, iteration: int) -> np.random.Generator:
    """Random stream of one shuffle; it depends on nothing but its arguments."""
    digest = hashlib.blake2b(f"{seed}/{name}/{iteration}".encode(), digest_size=16).digest()
    return np.random.Generator(np.random.PCG64(int.from_bytes(digest, "big")))


def _bits(rng: np.random.Generator) -> int:
    return int(rng.integers(0, 1 << 64, dtype=np.uint64))


def walk_seed(seed: int, name: str, iteration: int) -> int:
    """The 64 bits that decide one shuffle."""
    return _bits(iteration_rng(seed, name, iteration))


@dataclass(frozen=True)
class PairingScorer:
    """Stand-in energy: the best nested base pairing (Nussinov and Jacobson 1980).

    It is a simple published model, not a thermodynamic folding program, and its
    energies do not equal such a program's. ``max_span`` limits the distance of
    paired bases; ``None`` allows any distance.
    """

    max_span: int | None = None

    def available(self) -> bool:
        return True

    def fold(self, seqs: Sequence[str]) -> list[float | None]:
        """Energies of sequences, computed side by side.

        Shorter sequences are filled up with a letter that never pairs, which
        leaves their energies as they are.
        """
        size = max(map(len, seqs), default=0)
        kind = np.int16 if size < 20_000 else np.int32
        span = min(size - 1, self.max_span or size)
        if span <= MIN_LOOP:
            return [0.0] * len(seqs)
        pair = self._pair_energies(seqs, size)
        inside = [np.zeros((size - d, len(seqs)), kind) for d in range(span + 1)]
        closed: dict[int, np.ndarray] = {}
        # inside[d][i]: best energy of i..i+d. closed[d]: the same with i paired to i+d.
        for d in range(MIN_LOOP + 1, span + 1):
            count = size - d
            energy = pair(d)
            closed[d] = np.where(energy < 0, energy + inside[d - 2][1:count + 1],
                                 np.array(1, kind))
            best = np.minimum(inside[d - 1][1:], closed[d])
            for k in range(MIN_LOOP + 1, d):
                np.minimum(best, closed[k][:count] + inside[d - k - 1][k + 1:k + 1 + count],
                           out=best)
            inside[d] = np.minimum(best, 0)
        if span == size - 1:
            return inside[span][0].astype(float).tolist()
        return self._chain(closed, span, size, len(seqs))

    @staticmethod
    def _pair_energies(seqs, size):
        codes = np.zeros((len(seqs), size), np.uint8)
        for row, seq in zip(codes, seqs):
            # Letters outside ASCII become a question mark, which never pairs.
            row[:len(seq)] = np.frombuffer(seq.encode("ascii", "replace"), np.uint8)
        letters = np.zeros(256, np.int8)
        for number, names in enumerate(("Aa", "Cc", "Gg", "UuTt"), start=1):
            for name in names:
                letters[ord(name)] = number
        table = np.zeros(25, np.int8)
        for (first, second), energy in PAIR_ENERGY.items():
            x, y = letters[ord(first)], letters[ord(second)]
            table[5 * x + y] = table[5 * y + x] = energy
        codes = letters[np.ascontiguousarray(codes.T)]
        fives = codes * np.int8(5)
        return lambda d: table[fives[:-d] + codes[d:]]

    @staticmethod
    def _chain(closed, span, size, count):
        """Best sum of side-by-side closed stretches of at most ``span``."""
        widths = range(span, MIN_LOOP, -1)
        ends = np.ones((size, len(widths), count), np.int32)
        for column, d in enumerate(widths):
            ends[d:, column] = closed[d]
        best = np.zeros((size + span + 1, count), np.int32)
        for at in range(span + 1, size + span + 1):
            joined = ends[at - span - 1]
            joined += best[at - span - 1:at - MIN_LOOP - 1]
            np.minimum(best[at - 1], np.minimum.reduce(joined), out=best[at])
        return best[-1].astype(float).tolist()


@dataclass(frozen=True)
class NeighbourScorer:
    """Sums a whole number per pair of neighbouring letters, from their code points.

    A letter-pair shuffle cannot change such an energy, so the scores of all sequences are known
    beforehand: it checks the chain of shuffling, folding and reducing, and nothing else.
    """

    max_span = 1    # pairs are neighbours, so the cost is linear in the length

    def available(self) -> bool:
        return True

    def fold(self, seqs: Sequence[str]) -> list[float | None]:
        codes = (np.frombuffer(s.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
                 for s in seqs)
        return [-float(((31 * c[:-1] + 17 * c[1:]) % 7).sum()) for c in codes]


# Starts a program from a process that is small itself: a process begins with the peak memory of
# the one it was split off from, and a Python worker of Spark is large.
_WATCH = """
import os, sys
pid = os.fork()
if not pid:
    os.execvp(sys.argv[2], sys.argv[2:])
_, status, usage = os.wait4(pid, 0)
os.write(int(sys.argv[1]), str(usage.ru_maxrss).encode())
code = os.waitstatus_to_exitcode(status)
sys.exit(code if code >= 0 else 128 - code)
"""


def run_child(command: Sequence[str], given: bytes, timeout: float | None = None,
              measured: bool = False) -> tuple[bytes, int, int | None]:
    """Output and exit code of one program fed with ``given``, and if ``measured`` its peak memory in kB.

    The memory is that of this program and of programs it has waited for, not the peak of
    everything the worker has ever run. A thread feeds the program, so it may answer while it still
    reads. Raises ``TimeoutExpired`` when it takes longer, ``OSError`` when it cannot be run.
    """
    command = list(command)
    if shutil.which(command[0]) is None:
        raise FileNotFoundError(command[0])
    told, tell = os.pipe()
    start = [sys.executable, "-S", "-c", _WATCH, str(tell), *command] if measured else command
    late = threading.Event()
    try:
        with subprocess.Popen(start, stdin=subprocess.PIPE, stdout=subprocess.PIPE, stderr=subprocess.DEVNULL,
                              pass_fds=(tell,) if measured else (), start_new_session=True) as child:
            def feed() -> None:
                try:
                    with child.stdin:
                        child.stdin.write(given)
                except OSError:
                    pass    # it ended before it read all

            def stop() -> None:
                late.set()
                os.killpg(child.pid, signal.SIGKILL)

            feeder = threading.Thread(target=feed, daemon=True)
            timer = threading.Timer(timeout, stop) if timeout else None
            feeder.start()
            if timer:
                timer.start()
            out = child.stdout.read()
            code = child.wait()
            if timer:
                timer.cancel()
            feeder.join()
        os.close(tell)
        tell = None
        memory = os.read(told, 32)
    finally:
        os.close(told)
        if tell is not None:
            os.close(tell)
    if late.is_set():
        raise subprocess.TimeoutExpired(command, timeout)
    return out, code, int(memory) if memory else None


_ALONE = """
import json, sys
sys.path[:] = {path!r}
from pyspark import cloudpickle
scorer, seqs = cloudpickle.load(sys.stdin.buffer)
sys.stdout.write(json.dumps(scorer.fold(seqs)))
"""


def fold_alone(scorer, seqs: Sequence[str], timeout: float | None = None) -> tuple[list[float | None], int]:
    """Energies, and the peak memory in kB of the process that computed these and nothing else.

    A scorer that runs a program measures that program; any other is run in an interpreter of its own.
    """
    if hasattr(scorer, "fold_measured"):
        return scorer.fold_measured(seqs)
    from pyspark import cloudpickle

    program = [sys.executable, "-c", _ALONE.format(path=sys.path)]
    out, code, memory = run_child(program, cloudpickle.dumps((scorer, list(seqs))), timeout, measured=True)
    if code:
        raise RuntimeError(f"the scorer's process ended with code {code}")
    return json.loads(out), memory


@dataclass(frozen=True)
class CommandScorer:
    """An external folding program that reads FASTA and prints bracketed energies."""

    command: tuple[str, ...] = ("RNAfold", "--noPS")
    timeout: float | None = None

    def available(self) -> bool:
        return shutil.which(self.command[0]) is not None

    def fold(self, seqs: Sequence[str]) -> list[float | None]:
        """One energy per sequence; null where the program printed none.

        Raises if the program fails or leaves records unanswered, so that the caller can try the
        sequences one by one. A program that is missing or not executable raises ``OSError``.
        """
        return self._folded(seqs, measured=False)[0]

    def fold_measured(self, seqs: Sequence[str]) -> tuple[list[float | None], int]:
        """The same, and the program's peak memory in kB."""
        return self._folded(seqs, measured=True)

    def _folded(self, seqs: Sequence[str], measured: bool) -> tuple[list[float | None], int | None]:
        records = "".join(f">{i}\n{seq}\n" for i, seq in enumerate(seqs))
        out, code, memory = run_child(self.command, records.encode("utf-8", "replace"), self.timeout, measured)
        if code:
            raise RuntimeError(f"the folding program ended with code {code}")
        pattern = re.compile(MFE_LINE_PATTERN)
        energies: list[float | None] = [None] * len(seqs)
        answered, current = 0, -1
        for line in out.decode("utf-8", "replace").splitlines():
            if line.startswith(">"):
                answered, current = answered + 1, int(line[1:].split()[0])
            elif current >= 0 and energies[current] is None and (found := pattern.search(line)):
                energies[current] = float(found.group(1))
        if answered < len(seqs):
            raise RuntimeError(f"the folding program answered {answered} of {len(seqs)} records")
        return energies, memory

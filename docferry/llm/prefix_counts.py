"""Exact token counts of every prefix of a text, by dynamic programming over prefixes.

Within one group of the tokenizer's pattern, the last token of a prefix settles the rest: it is the one token that ends
the prefix and may follow the last token of what stands before it. Two tokens may follow each other if BPE leaves
their bytes as just these two. So count(prefix) = count(prefix without its last token) + 1, and one pass over the
prefixes of a group gives all its counts. They are kept as steps (differences, one signed byte a character) per
distinct group; a text's steps are those of its groups in turn, and their running sum is the count of every prefix.

Where a prefix is split into other groups than the whole text, the steps are set right at the place: the end of a
run of white space whose last character belongs to the next group, the middle of the contractions, and
places inside a special string.

Defined results: null text is empty (0 bytes, 0 tokens, fits); repeated and null ids keep their rows; an empty table
gives no rows; other columns of the input do not matter.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docferry.llm.bpe import Codec, codec, pre_tokens, white_space
from docferry.llm.common import slices

#: Distinct groups that a worker keeps, and as many pairs of tokens, and characters of those groups; when full, it starts
#: anew, but for the groups that its present texts have.
KEEP = 600_000
KEEP_CHARS = 32 << 20
#: Bytes of texts whose new groups are worked out together.
STEP_BYTES = 4 << 20

_TOKEN_BITS = 24
#: The parts of these contractions are other groups until their last letter is there.
_CONTRACTIONS = ("'re", "'ve", "'ll")
_TWO_BLANKS = regex.compile(r"\p{White_Space}{2}")


class PrefixCounter:
    """Prefix counts of texts for one tokenizer file."""

    def __init__(self, tokens: Codec, keep: int = KEEP):
        if tokens.fast is None:
            raise ValueError("prefix counts need a byte-level BPE file whose merges are in the order of their ids")
        self.tokens, self.keep = tokens, keep
        specials = set(tokens.specials.values())
        self.ids = {p: i for i, p in enumerate(tokens.pieces) if i not in specials}
        #: All beginnings of tokens and their numbers; as states of an Aho-Corasick automaton they tell which tokens end at a place.
        self.begins = {b"": 0}
        for piece in self.ids:
            for k in range(len(piece), 0, -1):
                if piece[:k] in self.begins:
                    break
                self.begins[piece[:k]] = len(self.begins)
        self.names = list(self.begins)
        #: Of states met so far, the tokens that their bytes end with, longest first, with their lengths.
        self.ends: list[tuple | None] = [None] * len(self.names)
        self.moves: dict[int, int] = {}
        self.steps: dict[str, bytes] = {}
        self.chars = 0
        #: One object for equal steps; there are far fewer than groups.
        self.equal: dict[bytes, bytes] = {}
        self.fits: dict[int, bool] = {}
        self.split = pre_tokens().findall

    def _may_follow(self, a: int, b: int) -> bool:
        """Whether BPE leaves the bytes of two tokens as these two; ``fits`` keeps the answer."""
        if len(self.fits) > self.keep:
            self.fits.clear()
        known = self.tokens.fast._encode_single_piece(self.tokens.pieces[a] + self.tokens.pieces[b]) == [a, b]
        self.fits[a << _TOKEN_BITS | b] = known
        return known

    def _move(self, state: int, byte: int) -> int:
        """The longest beginning of a token that the bytes of a state and one more end with; ``moves`` keeps the answer."""
        if len(self.moves) > self.keep:
            self.moves.clear()
        name = self.names[state] + bytes([byte])
        to = next(self.begins[name[k:]] for k in range(len(name)) if name[k:] in self.begins)
        if self.ends[to] is None:
            own = self.names[to]
            self.ends[to] = tuple((len(own) - k, self.ids[own[k:]]) for k in range(len(own)) if own[k:] in self.ids)
        self.moves[state << 8 | byte] = to
        return to

    def _extend(self, data: bytes, counts: list[int], last: list[int], states: list[int]) -> None:
        """Counts, last tokens and states of all prefixes of ``data``, given those of the first ones (entry 0: nothing)."""
        fits_of, move_of, ends = self.fits.get, self.moves.get, self.ends
        add_count, add_last, add_state = counts.append, last.append, states.append
        state = states[-1]
        for byte in data[len(counts) - 1 :]:
            to = move_of(state << 8 | byte)
            state = self._move(state, byte) if to is None else to
            add_state(state)
            for length, token in ends[state]:
                before = last[-length]
                may = before < 0 or fits_of(before << _TOKEN_BITS | token)
                if may or may is None and self._may_follow(before, token):
                    add_count(counts[-length] + 1)
                    add_last(token)
                    break

    def learn(self, groups: set[str]) -> None:
        """Work out the steps of new groups; in order of their bytes, so that each goes on from what it shares with the one before."""
        if not groups:
            return
        ordered = sorted(groups)  # in order of their bytes too
        encoded = [g.encode() for g in ordered]
        counts, last, states, found = [0], [-1], [0], []
        for data, shared in zip(encoded, _shared(encoded), strict=True):
            del counts[shared + 1 :], last[shared + 1 :], states[shared + 1 :]
            self._extend(data, counts, last, states)
            found += counts[1:]
        # of the counts after every byte, those at the end of a character
        begins = (np.frombuffer(b"".join([*encoded, b" "]), np.uint8) & 0xC0) != 0x80
        at_ends = np.asarray(found, np.int64)[begins[1:]]
        stops = np.cumsum([len(g) for g in ordered]).tolist()
        before = np.concatenate([[0], at_ends[:-1]])
        before[[0, *stops[:-1]]] = 0
        whole, start = (at_ends - before).astype(np.int8).tobytes(), 0
        for group, stop in zip(ordered, stops, strict=True):
            steps, start = whole[start:stop], stop
            if group in _CONTRACTIONS:
                one, two, three = steps
                steps = bytes([one, 1, two + three - 1 & 255])
            self.steps[group] = self.equal.setdefault(steps, steps)
        self.chars += len(whole)

    def group_count(self, group: str) -> int:
        """Tokens of one group."""
        counts = [0]
        self._extend(group.encode(), counts, [-1], [0])
        return counts[-1]

    def ordinary_steps(self, text: str, groups: list[str]) -> bytes:
        """Steps of a text without special strings, whose groups are known."""
        out, blank = list(map(self.steps.get, groups)), white_space()
        if not _TWO_BLANKS.search(text):
            return b"".join(out)
        runs = [k for k, (a, b) in enumerate(zip(groups, groups[1:], strict=False), 1) if b[0] in blank and a[-1] in blank]
        for k in runs:
            # until the next character comes, the whole run of blanks is one group
            run = groups[k - 1] + groups[k][0]
            off = self.group_count(run) - self.group_count(run[:-1]) - out[k][0]
            if off:
                out[k] = _shifted(out[k], 0, off)
                if len(out[k]) > 1:
                    out[k] = _shifted(out[k], 1, -off)
                else:
                    out[k + 1] = _shifted(out[k + 1], 0, -off)
        return b"".join(out)

    def steps_of(self, texts: list[str]) -> list[np.ndarray]:
        """For each text, the tokens that each character adds (or takes away); their running sum counts every prefix."""
        parts = [self.tokens.segments(t) for t in texts]
        groups = [[self.split(p) if i % 2 == 0 else [] for i, p in enumerate(own)] for own in parts]
        new = set()
        for own in groups:
            new.update(*own)
        known = new.intersection(self.steps)
        new -= known
        if len(self.steps) + len(new) > self.keep or self.chars > KEEP_CHARS:
            self.steps, self.chars = {g: self.steps[g] for g in known}, sum(map(len, known))
            self.equal = {steps: steps for steps in self.steps.values()}
        self.learn(new)
        return [self._steps(*own) for own in zip(parts, groups, strict=True)]

    def _steps(self, parts: list[str], groups: list[list[str]]) -> np.ndarray:
        if len(parts) == 1:
            return np.frombuffer(self.ordinary_steps(parts[0], groups[0]), np.int8)
        out = []
        for i, part in enumerate(parts):
            if i % 2 == 0:
                out.append(np.frombuffer(self.ordinary_steps(part, groups[i]), np.int8).astype(np.int64))
            else:
                before = self.tokens.ordinary(parts[i - 1])
                counts = [len(self.tokens.ordinary(parts[i - 1] + part[:j])) for j in range(1, len(part))]
                out.append(np.diff([len(before), *counts, len(before) + 1]))
        return np.concatenate(out)

    def prefix_counts(self, texts: list[str]) -> list[np.ndarray]:
        """For each text, the tokens of each prefix: entry k is the count of its first k characters."""
        out = []
        for text, steps in zip(texts, self.steps_of(texts), strict=True):
            out.append(np.zeros(len(text) + 1, np.int64))
            np.cumsum(steps, out=out[-1][1:])
        return out


def _shared(ordered: list[bytes], most: int = 24) -> list[int]:
    """How many first bytes, ``most`` at most, each string has in common with the one before."""
    rows = np.array(ordered, f"S{most}").view(np.uint8).reshape(-1, most)
    differ = rows[1:] != rows[:-1]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), most)
    size = np.fromiter(map(len, ordered), np.int64, len(ordered))
    return [0, *np.minimum(common, np.minimum(size[1:], size[:-1])).tolist()]


def _shifted(steps: bytes, at: int, by: int) -> bytes:
    changed = np.frombuffer(steps, np.int8).astype(np.int64)
    changed[at] += by
    return changed.astype(np.int8).tobytes()


def fitting_prefix(counts: np.ndarray, limit: int) -> int:
    """Characters of the longest prefix with at most ``limit`` tokens."""
    return int(np.flatnonzero(counts <= limit)[-1])


@functools.lru_cache(maxsize=1)
def counter(path: str) -> PrefixCounter:
    """The counter of a file with what it has learned, for all tasks of a worker."""
    return PrefixCounter(codec(path))


def count_tokens(df: DataFrame, tokenizer: str, *, limit: int, doc_id: str = "doc_id", text: str = "text", keep_steps: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit, fit_chars (longest prefix within ``limit`` tokens), and with ``keep_steps``
    the steps (binary, a signed byte a character), from which ``counts_of`` answers any later question."""
    rows = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = dict(rows.dtypes)["doc_id"]

    def count(batches):
        prefixes = counter(tokenizer)
        for batch in slices(batches, "text", STEP_BYTES):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            counts = prefixes.prefix_counts(texts)
            n_bytes, n_tokens = [len(t.encode()) for t in texts], [int(c[-1]) for c in counts]
            fit = [len(t) if c[-1] <= limit else fitting_prefix(c, limit) for t, c in zip(texts, counts, strict=True)]
            kept = [np.diff(c).astype(np.int8).tobytes() for c in counts] if keep_steps else []
            columns = {"doc_id": batch.column("doc_id"), "n_bytes": pa.array(n_bytes, pa.int64()), "n_tokens": pa.array(n_tokens, pa.int64()), "over_limit": pa.array([n > limit for n in n_tokens], pa.bool_()), "fit_chars": pa.array(fit, pa.int64())}
            if keep_steps:
                columns["steps"] = pa.array(kept, pa.binary())
            yield pa.RecordBatch.from_pydict(columns)

    schema = f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean, fit_chars long"
    return rows.mapInArrow(count, schema + ", steps binary" * keep_steps)


def counts_of(steps: bytes) -> np.ndarray:
    """Token counts of all prefixes from stored steps."""
    out = np.zeros(len(steps) + 1, np.int64)
    np.cumsum(np.frombuffer(steps, np.int8), out=out[1:])
    return out

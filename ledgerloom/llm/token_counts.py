"""Token counts by a finite-state transducer compiled from a tokenizer's vocabulary.

A merge never crosses two neighbouring characters that stand together in no
piece. Such places cut a text into fragments whose tokens do not depend on each
other. The transducer reads bytes; its states are the fragments read so far,
and a transition over a cut is annotated with the number of tokens that the
fragment before it emits, as the tokenizer itself gives them. It is
determinised lazily, as texts need states, up to a bound; what lies beyond
(rare or very long fragments) passes through states that remember the last
character only, and the tokenizer counts the fragment when its cut is reached.

Texts are split into chunks that run in lockstep, one table lookup for each
byte position of all chunks. A chunk's map from entry state to (exit state,
tokens) is constant after its first cut, so composing the maps of neighbours
means to run the exit state of one through the head of the next; all chunks do
so at once, those after a chunk without a cut again until nothing changes, and
the sums of a text's chunks are its count.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import fresh, ship, text_of, without

RESULT = ("n_bytes", "n_tokens")
CHUNK = 512  # bytes run by one lane
BATCH = 8 << 20  # bytes in flight
LONGEST = 96  # bytes of a fragment that get states of their own
STATES = 1 << 16
STATE_BITS = 17
MASK = (1 << STATE_BITS) - 1
AHEAD = (1 << (31 - STATE_BITS)) - 1  # annotation: the tokenizer counts this fragment


class Transducer:
    def __init__(self, model_file: str, states: int = STATES, longest: int = LONGEST):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.limit, self.longest = states, longest
        own = self.library
        pieces = [
            own.id_to_piece(i) for i in range(own.get_piece_size())
            if not (own.is_byte(i) or own.is_control(i) or own.is_unknown(i))
        ]
        self.pairs = {p[i:i + 2].replace("▁", " ") for p in pieces for i in range(len(p) - 1)}
        self.chars = {c for pair in self.pairs for c in pair}
        self.counted: dict[bytes, int] = {}
        self.reset()

    def reset(self) -> None:
        self.table = np.full((4096, 256), -1, np.int32)
        self.states: list[tuple[str | None, str, bytes]] = []
        self.ids: dict[tuple[str | None, str, bytes], int] = {}
        self.state("", "", b"")

    def state(self, fragment: str | None, last: str, part: bytes) -> int:
        """The id of a state; ``fragment`` is None where only the last character is known."""
        key = (fragment, last, part)
        found = self.ids.get(key)
        if found is None:
            if fragment and (len(self.states) >= self.limit or len(fragment) > self.longest):
                return self.state(None, last, part)
            found = self.ids[key] = len(self.states)
            self.states.append(key)
            if found >= len(self.table):
                self.table = np.concatenate([self.table, np.full_like(self.table, -1)])
        return found

    def tokens(self, fragments: list[bytes]) -> list[int]:
        """Tokens of each fragment, by the library where they aren't known yet."""
        known = self.counted
        new = [f for f in set(fragments) if f not in known]
        if new:
            if len(known) > 1 << 18:
                known.clear()
                new = list(set(fragments))
            # a line break is in no piece: the library's first two tokens are its own
            ids = self.library.encode(["\n" + f.decode("utf-8") for f in new], num_threads=1)
            known.update(zip(new, [len(i) - 2 for i in ids], strict=True))
        return [known[f] for f in fragments]

    def learn(self, state: int, byte: int) -> int:
        fragment, last, part = self.states[state]
        part += bytes([byte])
        wanted = 1 if part[0] < 0x80 else 2 if part[0] < 0xE0 else 3 if part[0] < 0xF0 else 4
        emitted = 0
        if len(part) < wanted:
            to = self.state(fragment, last, part)
        else:
            char = part.decode("utf-8")
            known = char if char in self.chars else ""  # of other characters only the text tells which
            if not last and fragment == "":
                to = self.state(char if known else None, known, b"")
            elif last + char in self.pairs:
                to = self.state(None if fragment is None else fragment + char, char, b"")
            else:
                emitted = AHEAD if fragment is None else min(self.tokens([fragment.encode("utf-8")])[0], AHEAD)
                to = self.state(char if known else None, known, b"")
        value = emitted << STATE_BITS | to
        self.table[state, byte] = value
        return value

    def step(self, states: np.ndarray, bytes_: np.ndarray) -> np.ndarray:
        at = states.astype(np.int64) << 8 | bytes_
        values = self.table.ravel()[at]
        if values.min(initial=0) < 0:
            for key in np.unique(at[values < 0]).tolist():
                self.learn(key >> 8, key & 255)
            values = self.table.ravel()[at]
        return values

    def counts(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text."""
        if len(self.states) > 2 * self.limit or len(self.states) > MASK - (1 << 14):
            self.reset()
        out = np.zeros(len(texts), np.int64)
        full = [i for i, t in enumerate(texts) if t]
        if not full:
            return out
        # the tokenizer puts a blank before a text, and takes its mark for a blank as one
        parts = [(" " + texts[i].replace("▁", " ")).encode("utf-8") for i in full]
        data = b"".join(parts)
        stream = np.frombuffer(data, np.uint8)
        ends = np.cumsum([len(p) for p in parts])
        starts = ends - [len(p) for p in parts]

        # chunks, moved forward to where a character begins
        n_chunks = -(-(ends - starts) // CHUNK)
        doc = np.repeat(np.arange(len(parts)), n_chunks)
        first = np.cumsum(n_chunks) - n_chunks
        begin = starts[doc] + (np.arange(len(doc)) - first[doc]) * CHUNK
        for _ in range(3):
            inside = (begin < ends[doc]) & (stream[np.minimum(begin, len(stream) - 1)] & 0xC0 == 0x80)
            begin = begin + inside
        is_last = np.arange(len(doc)) == (first + n_chunks - 1)[doc]
        end = np.where(is_last, ends[doc], np.append(begin[1:], 0))
        is_first = np.arange(len(doc)) == first[doc]

        whole = np.where(is_first, starts[doc], -1)
        total, cut, exits, last_cut = self._run(
            data, stream, begin, end - begin, np.zeros(len(doc), np.int64), whole, drop_first=~is_first)
        last_cut = np.maximum.accumulate(last_cut)  # a chunk without a cut goes on with what is open
        # heads: the exit state of the chunk before, run up to the first cut; again where that chunk had
        # no cut of its own and its exit state or last cut came out different
        todo, heads = np.flatnonzero(~is_first), np.zeros(len(doc), np.int64)
        while len(todo):
            length = np.where(cut[todo] >= 0, cut[todo] + 1, (end - begin)[todo])
            heads[todo], _, through, reached = self._run(
                data, stream, begin[todo], length, exits[todo - 1], last_cut[todo - 1])
            uncut = cut[todo] < 0
            new_exits, new_cut = exits.copy(), last_cut.copy()
            new_exits[todo[uncut]] = through[uncut]
            new_cut[todo[uncut]] = np.maximum(new_cut[todo[uncut]], reached[uncut])
            new_cut = np.maximum.accumulate(new_cut)
            moved = np.flatnonzero((new_exits != exits) | (new_cut != last_cut)) + 1
            exits, last_cut = new_exits, new_cut
            todo = moved[moved < len(doc)]
            todo = todo[~is_first[todo]]
        total += heads
        # what is open at the end of a text
        total[is_last] += self.tokens([data[a:b] for a, b in zip(last_cut[is_last].tolist(), ends.tolist(), strict=True)])
        out[full] = np.add.reduceat(total, first)
        return out

    def _run(self, data, stream, begin, length, entry, open_from, drop_first=None):
        """Tokens emitted by each chunk, the place of its first cut, its exit state, its last cut.

        ``open_from``: where the fragment that is open at entry begins.
        ``drop_first``: chunks whose first emission is left out, because what it
        counts begins in the chunk before.
        """
        order = np.argsort(-length, kind="stable")
        at, left = begin[order], length[order]
        state, opened = entry[order].astype(np.int64), open_from[order].astype(np.int64)
        total, cut = np.zeros(len(order), np.int64), np.full(len(order), -1, np.int64)
        skip = np.zeros(len(order), bool) if drop_first is None else drop_first[order]
        descending = -left
        later: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # what the library counts
        for j in range(int(left[0]) if len(left) else 0):
            n = int(np.searchsorted(descending, -j, "left"))
            values = self.step(state[:n], stream[at[:n] + j])
            state[:n] = values & MASK
            emits = np.flatnonzero(values >= 1 << STATE_BITS)
            if not len(emits):
                continue
            emitted = (values[emits] >> STATE_BITS).astype(np.int64)
            place = at[emits] + j
            for _ in range(3):  # the cut is before the character that ends here
                place -= stream[place] & 0xC0 == 0x80
            counts = ~(skip[emits] & (cut[emits] < 0))
            ahead = emitted == AHEAD
            if ahead.any():
                chosen = ahead & counts
                later.append((emits[chosen], opened[emits[chosen]], place[chosen]))
                counts &= ~ahead
            total[emits[counts]] += emitted[counts]
            opened[emits] = place
            cut[emits[cut[emits] < 0]] = j
        if later:
            lanes, froms, tos = (np.concatenate(x) for x in zip(*later, strict=True))
            found = self.tokens([data[a:b] for a, b in zip(froms.tolist(), tos.tolist(), strict=True)])
            np.add.at(total, lanes, found)
        out = []
        for ordered in (total, cut, state, opened):
            back = np.empty_like(ordered)
            back[order] = ordered
            out.append(back)
        return out


@cache
def transducer(model_file: str) -> Transducer:
    """One for each Python worker, kept between tasks."""
    return Transducer(model_file)


def _in_batches(texts: pd.Series) -> Iterator[list[str]]:
    batch, size = [], 0
    for text in texts:
        if size + len(text) > BATCH and batch:
            yield batch
            batch, size = [], 0
        batch.append(text)
        size += len(text)
    if batch:
        yield batch


def token_counts(docs: DataFrame, model_file: str, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with ``n_bytes`` (UTF-8) and ``n_tokens``.

    The counts are those of the tokenizer in ``model_file`` for the whole text,
    without tokens for begin and end; strings of special tokens are ordinary
    text. A null text counts as empty and has no token. Every row gives one row.
    An input column named like a result column is replaced.
    """
    ship(docs.sparkSession)
    docs = without(docs, *RESULT)
    (found,) = fresh(docs, "found")

    @F.pandas_udf("n_bytes long, n_tokens long")
    def count(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        counter = transducer(model_file)
        for texts in series:
            n_tokens = [counter.counts(batch) for batch in _in_batches(texts)]
            yield pd.DataFrame({
                "n_bytes": [len(t.encode("utf-8")) for t in texts],
                "n_tokens": np.concatenate(n_tokens) if n_tokens else np.zeros(0, np.int64),
            })

    counted = docs.withColumn(found, count(text_of(text_col)))
    return counted.select(*[F.col(f"`{c}`") for c in docs.columns], f"{found}.n_bytes", f"{found}.n_tokens")

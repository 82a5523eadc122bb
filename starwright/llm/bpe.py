"""Byte-pair encoding by a tokenization automaton.

The automaton reads token labels. It starts as one state that every byte loops
on, and each merge (u, v) -> uv, in order of rank, adds a gadget: arrivals by u
get a state of their own that lacks the arc v, and wherever u then v could be
read, an arc uv now leads where v led. What is left after the last merge are
exactly the right token sequences, one for each byte string. All arrivals by
one label share a state, so the state is the label last read. Two labels t, x
are joined by an arc unless a gadget took it away: a merge (s, y) of rank m,
where s is t or an ending that t was built from (its arcs were copied when the
label above it was made, so m must be less than that rank), and y is x or a
beginning that x was built from (the arc of the label above it was made from
y's, so m must be at most that rank). The driver compiles merges to flat arrays
of these chains and gadgets, and the labels' bytes to a tree.

To read bytes instead of labels, the automaton is made deterministic: after
some bytes, its state is the tree's nodes that the last bytes lead to, each with
the label that ends where its bytes begin, and the label that ends here. That
label is one alone: of those that end at the nodes, the one with an arc from
the label before it. States get their numbers, and rows of 256 next states in
one table, when they are first entered; then a byte costs one look into the
table. Its size is bounded whatever the texts: states beyond it are stepped
through without a number.
Encoding steps through a pre-split word byte by byte and reads the labels back
from its end, in time linear in the word; decoding emits the labels' bytes.
"""

from __future__ import annotations

import hashlib
import json
import os
import pickle
import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NEVER = 1 << 60
#: Two labels in one integer.
SHIFT = 32
#: A node of the tree and a label in one integer; all bits of the label set: none.
NODE, NODE_LOW = 24, (1 << 24) - 1
#: States of the byte automaton that a worker keeps: 32 MB of next states.
MOST_STATES = 1 << 15
#: Steps beside a full table before it is begun anew.
MOST_BESIDE = 1 << 21
#: Pairs of labels whose arc a worker keeps: some 25 MB.
MOST_ARCS = 1 << 18
#: Words whose ids a worker keeps, and the longest of them: some 50 MB.
MOST_WORDS = 1 << 18
LONGEST_KEPT = 32
#: No label: the start of a word.
START = -1

# Fixed values of byte-level tokenizers: the words that texts are split into.
# White space is Unicode's; in ASCII texts that is the six characters of ``\s``.
WORDS = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
ASCII_WORDS = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+", re.ASCII
)


def byte_characters() -> dict[str, int]:
    """Of each character that stands for a byte in byte-level vocabularies, that byte.

    Printable bytes stand for themselves; the others, in order, for the
    characters from 256 on.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Compiled:
    """An automaton as flat arrays, a few megabytes that the driver sends to the workers.

    ``vocabulary``: label bytes to id; ``merges``: pairs of label bytes;
    ``special``: strings found in a text before all else, to their ids.
    """

    def __init__(self, vocabulary: dict[bytes, int], merges: list[tuple[bytes, bytes]], special: dict[str, int]):
        self.special = special
        size = max([*vocabulary.values(), *special.values()], default=-1) + 1
        self.labels = [b""] * size
        for word, i in [*vocabulary.items(), *((x.encode(), i) for x, i in special.items())]:
            self.labels[i] = word
        # Of each label the next ending and the next beginning that it was built from, with the
        # rank of the merge that built it: the ends of a chain are the labels of single bytes.
        self.next_ending, self.next_beginning, self.rank = (array("i", [START]) * size for _ in range(3))
        self.gadget: dict[int, int] = {}
        id_of = {x: i for x, i in vocabulary.items() if len(x) == 1}
        for rank, (u, v) in enumerate(merges):
            if u in id_of and v in id_of and self.has_arc(id_of[u], id_of[v]):
                self.gadget[id_of[u] << SHIFT | id_of[v]] = rank
                made = vocabulary[u + v]
                if u + v not in id_of:
                    id_of[u + v] = made
                    self.next_ending[made], self.next_beginning[made], self.rank[made] = id_of[v], id_of[u], rank
        # The bytes of labels as a tree. Nodes are numbered level by level, so that the nodes after
        # one node, for the bytes in ``after``, are ``first`` and those behind it.
        tree: list[dict] = [{}]
        of_node: dict[int, int] = {}
        for word, i in id_of.items():
            node = 0
            for byte in word:
                if byte not in tree[node]:
                    tree[node][byte] = len(tree)
                    tree.append({})
                node = tree[node][byte]
            of_node[node] = i
        order, self.first = [0], array("i")
        for node in order:
            self.first.append(len(order))
            order += [tree[node][byte] for byte in sorted(tree[node])]
        self.after = [bytes(sorted(tree[node])) for node in order]
        self.ends = array("i", [of_node.get(node, START) for node in order])

    def has_arc(self, before: int, label: int) -> bool:
        """Whether the state after one label has an arc for another."""
        gadget, ranks, ending_of, beginning_of = self.gadget, self.rank, self.next_ending, self.next_beginning
        beginning, built = label, NEVER
        while beginning >= 0:
            ending, copied = before, NEVER
            while ending >= 0:
                rank = gadget.get(ending << SHIFT | beginning)
                if rank is not None and rank < copied and rank <= built:
                    return False
                copied = ranks[ending]
                ending = ending_of[ending]
            built = ranks[beginning]
            beginning = beginning_of[beginning]
        return True


def cut_of(word: bytes) -> list[str]:
    """The pieces of one word of a text, after a space."""
    return WORDS.findall(" " + word.decode("utf-8", "replace"))


class Automaton:
    """The byte automaton over a compiled one: states, next states and words met.

    What it keeps for the texts to come is bounded, some 120 MB, and goes when a
    task ends; the compiled arrays stay with the worker.
    """

    def __init__(self, compiled: Compiled, most_states: int | None = None):
        self.compiled, self.most_states = compiled, most_states or MOST_STATES
        self.label, self.special = compiled.labels, compiled.special
        self.size = array("i", map(len, compiled.labels))
        longest_first = sorted(self.special, key=len, reverse=True)
        self.split = regex.compile("|".join(map(regex.escape, longest_first))) if self.special else None
        self.forget()

    def forget(self) -> None:
        """Drop what was kept of the texts so far."""
        self.arcs: dict[int, bool] = {}
        self.words: dict[str, bytes] = {}
        self._begin()

    def _begin(self) -> None:
        self.next = array("i", _NO_ROW)
        self.read = array("i", [START])  # the label that ends at a state
        # A state: the tree's nodes, longest first, down to the root, each with the label before it.
        self.content: list[tuple[int, ...]] = [(START & NODE_LOW,)]
        self.number: dict[tuple[int, ...], int] = {self.content[0]: 0}
        self.beside = 0

    def _step(self, content: tuple[int, ...], byte: int) -> tuple[tuple[int, ...], int]:
        """What a state holds after a byte, and the label that ends there."""
        first, after, ends, arcs = self.compiled.first, self.compiled.after, self.compiled.ends, self.arcs
        held, reached = [], START
        for pair in content:
            node, last = pair >> NODE, pair & NODE_LOW
            at = after[node].find(byte)
            if at >= 0:
                to = first[node] + at
                if after[to]:  # other nodes matter no more after this byte
                    held.append(to << NODE | last)
                if reached < 0 and (label := ends[to]) >= 0:
                    arc = last == NODE_LOW or arcs.get(last << SHIFT | label)
                    if arc is None:
                        if len(arcs) >= MOST_ARCS:
                            arcs.clear()
                        arc = arcs[last << SHIFT | label] = self.compiled.has_arc(last, label)
                    if arc:
                        reached = label
        if reached < 0:
            raise ValueError(f"no labels spell byte {byte} here")
        held.append(reached)  # at the root
        return tuple(held), reached

    def _number(self, content: tuple[int, ...], reached: int) -> int:
        """The number of a state, with a row of its own in the table; -1 if that is full."""
        found = self.number.get(content)
        if found is None:
            if len(self.content) >= self.most_states:
                return -1
            found = self.number[content] = len(self.content)
            self.content.append(content)
            self.read.append(reached)
            self.next.extend(_NO_ROW)
        return found

    def _path(self, word: bytes) -> list[int] | array:
        """The ids of a word's labels.

        States that a full table has no place for are stepped through beside
        it; after many of those the table is begun anew.
        """
        read = [] if len(word) <= LONGEST_KEPT else array("i")
        state, content, next_, label = 0, (), self.next, self.read
        for byte in word:
            if state >= 0:
                to = next_[state << 8 | byte]
                if to >= 0:
                    state = to
                    read.append(label[to])
                    continue
                content = self.content[state]
            content, reached = self._step(content, byte)
            read.append(reached)
            if state >= 0:
                to = self._number(content, reached)
                if to >= 0:
                    next_[state << 8 | byte] = to
                state = to
            else:
                self.beside += 1
                if self.beside > MOST_BESIDE:
                    self._begin()
                    next_, label = self.next, self.read
                    state = self._number(content, reached)
        size, at, path = self.size, len(word), read[:0]
        while at:
            ends = read[at - 1]
            path.append(ends)
            at -= size[ends]
        path.reverse()
        return path

    def encode_word(self, word: bytes) -> list[int]:
        """The labels read from the start to the end of a word: the only path of arcs."""
        return list(self._path(word))

    def encode_all(self, letters: np.ndarray, start: np.ndarray, size: np.ndarray, before: bytes) -> tuple[np.ndarray, np.ndarray]:
        """The ids of many words, as ``encode_word`` gives them, laid end to end, and each one's number of them.

        A word is ``before`` and ``size`` bytes of ``letters`` from ``start``.
        All take a byte at a time together, as far as the table of next states
        reaches; those that leave it, and very long ones, go by themselves.
        """
        order = np.argsort(-size, kind="stable")
        order = order[size[order] <= LONGEST_KEPT]
        most, ahead = int(size[order].max(initial=0)), len(before)
        # The label that ends after each byte, and whether the table has all the steps so far.
        read = np.full((ahead + most + 1, len(order)), START, np.int32)
        known, state = np.ones(len(order), bool), np.zeros(len(order), np.int64)
        next_, label = np.frombuffer(self.next, np.int32), np.frombuffer(self.read, np.int32)
        for at in range(-ahead, most):
            n = len(order) if at < 0 else int(np.searchsorted(-size[order], -at))  # longer words stand first
            to = next_[state[:n] << 8 | (before[at] if at < 0 else letters[start[order[:n]] + at])]
            known[:n] &= to >= 0
            state[:n] = np.maximum(to, 0)
            read[ahead + at + 1, :n] = label[state[:n]]
        del next_, label  # the table may grow again
        length = np.frombuffer(self.size, np.int32)
        left = np.flatnonzero(known)
        end, back = size[order[left]] + ahead, []
        left, end = left[end > 0], end[end > 0]
        counts = np.zeros(len(size), np.int64)
        while len(left):
            ids = read[end, left]
            back.append((order[left], ids))
            counts[order[left]] += 1
            end = end - length[ids]
            left, end = left[end > 0], end[end > 0]
        apart = np.ones(len(size), bool)
        apart[order[known]] = False
        alone = {i: self._path(before + letters[start[i] : start[i] + size[i]].tobytes()) for i in np.flatnonzero(apart).tolist()}
        for i, ids in alone.items():
            counts[i] = len(ids)
        ends = counts.cumsum()
        out, last = np.empty(counts.sum(), np.int64), ends.copy()
        for which, ids in back:  # from the words' ends
            last[which] -= 1
            out[last[which]] = ids
        for i, ids in alone.items():
            out[ends[i] - len(ids) : ends[i]] = ids
        return out, counts

    def spell(self, word: bytes) -> list[int]:
        """The ids of one word of a text, after a space; the word is not kept for the next time."""
        if word.isalpha():  # ASCII letters: one piece
            return self.encode_word(b" " + word)
        return [i for piece in cut_of(word) for i in self.encode_word(piece.encode())]

    def _encode_plain(self, text: str) -> bytes:
        out, kept = [], self.words
        for word in (ASCII_WORDS if text.isascii() else WORDS).findall(text):
            ids = kept.get(word)
            if ids is None:
                ids = array("i", self._path(word.encode())).tobytes()
                if len(word) <= LONGEST_KEPT:
                    if len(kept) >= MOST_WORDS:
                        kept.clear()
                    kept[word] = ids
            out.append(ids)
        return b"".join(out)

    def encode(self, text: str, special: bool = True) -> bytes:
        """The ids of a text, as little-endian unsigned 32-bit integers."""
        if self.split is None or not special:
            return self._encode_plain(text)
        out, at = [], 0
        for found in self.split.finditer(text):
            out.append(self._encode_plain(text[at : found.start()]))
            out.append(np.array([self.special[found[0]]], "<u4").tobytes())
            at = found.end()
        out.append(self._encode_plain(text[at:]))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """The text that ids spell; bytes that are not UTF-8 become U+FFFD, unknown ids nothing."""
        label = self.label
        wide = np.frombuffer(ids, "<u4")
        return b"".join([label[i] for i in wide[wide < len(label)].tolist()]).decode("utf-8", "replace")


_NO_ROW = array("i", [-1]) * 256


def parse(definition: str) -> Compiled:
    """From the text of a byte-level tokenizer file."""
    model = json.loads(definition)
    byte = byte_characters()
    raw = lambda token: bytes(byte[c] for c in token)
    special = {x["content"]: x["id"] for x in model["added_tokens"]}
    merges = [x.split(" ") if isinstance(x, str) else x for x in model["model"]["merges"]]
    vocabulary = {raw(t): i for t, i in model["model"]["vocab"].items() if t not in special}
    return Compiled(vocabulary, [(raw(a), raw(b)) for a, b in merges], special)


@lru_cache(maxsize=2)
def _packed(path: str, modified: int) -> tuple[bytes, int]:
    """A compiled tokenizer file, as bytes, and its number of ids; the driver compiles a file once."""
    with open(path, encoding="utf-8") as file:  # a vocabulary file installed with the driver
        compiled = parse(file.read())
    return pickle.dumps(compiled, pickle.HIGHEST_PROTOCOL), len(compiled.labels)


class Definition:
    """A tokenizer file, compiled on the driver and sent to the workers as arrays."""

    def __init__(self, spark, path: str, most_states: int | None = None):
        packed, self.n_ids = _packed(path, os.stat(path).st_mtime_ns)
        self.most_states = most_states
        self.digest = f"{hashlib.sha256(packed).hexdigest()}-{most_states}"
        self.holder = spark.sparkContext.broadcast(packed)

    def automaton(self) -> Automaton:
        """This worker's automaton; the one before it, of another definition, goes."""
        if self.digest not in _held:
            _held.clear()
            _held[self.digest] = Automaton(pickle.loads(self.holder.value), self.most_states)
        return _held[self.digest]


_held: dict[str, Automaton] = {}


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


#: The id of "<|endoftext|>" in the default vocabulary.
END_OF_TEXT = 50256


def narrowed(ids: bytes) -> bytes:
    wide = np.frombuffer(ids, "<u4")
    if len(wide) and wide.max() > 0xFFFF:
        raise ValueError("ids need more than 16 bits")
    return wide.astype("<u2").tobytes()


def encode(docs: DataFrame, vocabulary: str | None = None, text: str = "text", ids: str = "ids", width: int = 4, special: bool = True) -> DataFrame:
    """Add the packed ids of every whole text, ``width`` bytes each; null texts are empty.

    Two bytes need a vocabulary below 65,536 ids. Without ``special``, the
    strings of special tokens are ordinary text. A column called ``ids`` is
    replaced; all others stay.
    """
    definition = Definition(docs.sparkSession, vocabulary or default_vocabulary())
    others = [c for c in docs.columns if c.lower() != ids.lower()]
    docs, place = docs.select(*others), others.index(text)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)

    def apply(batches):
        automaton = definition.automaton()
        for batch in batches:
            out = [automaton.encode(t or "", special) for t in batch.column(place).to_pylist()]
            if width == 2:
                out = [narrowed(x) for x in out]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], names=[*others, ids])
        automaton.forget()  # the worker goes on to other tasks

    return docs.mapInArrow(apply, f"{fields}, `{ids}` binary")


def decode(encoded: DataFrame, vocabulary: str | None = None, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Add the text that packed ids spell; null ids are none. A column called ``text`` is replaced."""
    definition = Definition(encoded.sparkSession, vocabulary or default_vocabulary())
    others = [c for c in encoded.columns if c.lower() != text.lower()]
    encoded, place = encoded.select(*others), others.index(ids)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)

    def apply(batches):
        automaton = definition.automaton()
        for batch in batches:
            out = [automaton.decode(x or b"") for x in batch.column(place).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string())], names=[*others, text])

    return encoded.mapInArrow(apply, f"{fields}, `{text}` string")


def round_trip(docs: DataFrame, vocabulary: str | None = None, text: str = "text") -> DataFrame:
    """Encode, decode, and add ``n_tokens`` and the SHA-256 digests of ids and decoded text.

    The columns ``ids`` and ``decoded`` hold the ids and the text. Both are made
    in one pass, so that a task needs one Python worker; columns with the names
    of those added are replaced, all others stay.
    """
    definition = Definition(docs.sparkSession, vocabulary or default_vocabulary())
    added = ("ids", "decoded", "n_tokens", "ids_sha256", "decoded_sha256")
    others = [c for c in docs.columns if c.lower() not in added]
    docs, place = docs.select(*others), others.index(text)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)

    def apply(batches):
        automaton = definition.automaton()
        for batch in batches:
            ids = [automaton.encode(t or "") for t in batch.column(place).to_pylist()]
            decoded = [automaton.decode(x) for x in ids]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(ids, pa.binary()), pa.array(decoded, pa.string())], names=[*others, "ids", "decoded"]
            )
        automaton.forget()  # the worker goes on to other tasks

    coded = docs.mapInArrow(apply, f"{fields}, ids binary, decoded string")
    return coded.withColumns(
        {
            "n_tokens": (F.octet_length("ids") / 4).cast("long"),
            "ids_sha256": F.sha2("ids", 256),
            "decoded_sha256": F.sha2(F.col("decoded").cast("binary"), 256),
        }
    )

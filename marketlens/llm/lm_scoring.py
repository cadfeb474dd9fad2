"""Operator 7: language-model scores by a weighted backoff automaton.

States are the contexts (the last 0 to order - 1 tokens) seen in training, arcs the n-grams seen after them. An arc of state u with
token w weighs (c(u w) + m P(w | u')) / (c(u) + m), the failure arc from u to its shorter context u' weighs m / (c(u) + m), with
m the prior weight; the empty context has the add-one estimate of the base score and an arc for every token. So the
weights of each state sum to one. A text is read once from left to right: where the state has no arc for the token, the failure
arcs are followed and their weights counted until one has; the arc leads to the longest context of the tokens read that is a state.

Each block of documents has the part of the automaton that its own tokens can reach: a table of states with their failure arcs and a table of
arcs sorted by state and token (``Automaton``). Its documents are walked in step, as lanes that each carry a state. A long text
makes several lanes: a state tells no more than the last order - 1 tokens, so a later lane reads those before its first token
from the empty context, without counting them, and stands in the state that a single walk would have reached.

What the automaton needs is exact counts over the whole training corpus. Documents are dealt to blocks of bounded size by the place of their row, not
by what it holds, so that rows alike do not meet; each block
sends its distinct n-grams as packed, sorted 64-bit hashes to counting groups (dealt by the hash, so no n-gram is hot: each block
sends it once), and gets back their counts in the same order. Only counts of n-grams that occur in a block ever reach
it; the model is nowhere whole. 64-bit hashes of different n-grams may collide with a probability of about n^2 / 2^65.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.llm.common import held_out, read_table, segment_sums, starts

ORDER = 2
PRIOR = 8.0
# Characters of text in a block, as an average: what a task holds at once.
BLOCK_CHARS = 12_000_000
# Counting groups for each block.
GROUPS_A_BLOCK = 2
# Tokens that a lane reads, besides those that set its state.
LANE_TOKENS = 1024
END = b"\n"  # no word holds white space

U64 = np.uint64


def _mix(h: np.ndarray) -> np.ndarray:
    """A full mix of 64-bit values (the finisher of a well-known hash)."""
    h = (h ^ (h >> U64(33))) * U64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> U64(33))) * U64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U64(33))


class Tokens:
    """The n-grams of a block of documents: hashes by order, the distinct ones numbered in ascending order of their hash.

    Tokens are the words of the text after lower-casing A-Z, cut at the six ASCII white-space characters, and one end a document.
    An n-gram ends at its token and begins no earlier than its document; the first token's bigram starts with a start mark.
    """

    def __init__(self, texts: list[str], order: int) -> None:
        numbers: dict[bytes, int] = {END: 0}
        words = [t.encode("utf-8", "surrogatepass").lower().split() for t in texts]
        self.offsets = starts(np.fromiter((len(w) + 1 for w in words), np.int64, len(words)))
        seq = np.fromiter((numbers.setdefault(w, len(numbers)) for own in words for w in (*own, END)), np.int64, int(self.offsets[-1]))
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, numbers), U64, len(numbers))
        first = np.zeros(len(seq), bool)
        first[self.offsets[:-1]] = True
        self.grams: list[np.ndarray] = []  # by order: distinct hashes, ascending
        self.place: list[np.ndarray] = []  # by order: place of each token's n-gram among them, -1 if it has none
        self.where: list[np.ndarray] = []  # by order: a token at which each of them ends
        gram, valid, back = hashes[seq], np.ones(len(seq), bool), hashes[seq]
        for n in range(1, order + 1):
            if n > 1:
                # The n-gram before, ended one token earlier, with this token added; at the start of a text the start mark.
                longer = np.empty_like(gram)
                longer[1:] = gram[:-1]
                start = first & (n == 2)
                longer[start] = U64(n)
                inner = np.zeros(len(seq), bool)
                inner[1:] = valid[:-1] & ~first[1:]
                gram, valid = _mix(longer * U64(0x9E3779B97F4A7C15) + back), inner | start
                gram = gram ^ U64(n)
            own, where, place = np.unique(gram[valid], return_index=True, return_inverse=True)
            self.grams.append(own)
            self.where.append(np.flatnonzero(valid)[where])
            at = np.full(len(seq), -1, np.int64)
            at[valid] = place
            self.place.append(at)
        self.first = first


def _pack(hashes: np.ndarray, counts: np.ndarray) -> bytes:
    """Ascending hashes and their counts: differences of the hashes, compressed column by column of bytes."""
    steps = np.diff(hashes, prepend=U64(0))
    columns = np.concatenate([steps.view(np.uint8).reshape(-1, 8).T.ravel(), counts.astype("<u4").view(np.uint8).reshape(-1, 4).T.ravel()])
    return zlib.compress(columns.tobytes(), 1)


def _unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(zlib.decompress(data), np.uint8)
    n = len(raw) // 12
    steps = np.ascontiguousarray(raw[: 8 * n].reshape(8, n).T).view(U64).ravel()
    return np.cumsum(steps, dtype=U64), np.ascontiguousarray(raw[8 * n:].reshape(4, n).T).view("<u4").ravel()


def _pack_counts(counts: np.ndarray) -> bytes:
    return zlib.compress(np.ascontiguousarray(counts.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def _unpack_counts(data: bytes) -> np.ndarray:
    raw = np.frombuffer(zlib.decompress(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(8, -1).T).view("<u8").ravel()


def _group_edges(hashes: np.ndarray, groups: int) -> np.ndarray:
    """Where each counting group's stretch of the ascending hashes ends: groups share the hash range evenly."""
    width = 2**64 // groups
    return np.append(np.searchsorted(hashes, np.array([width * (g + 1) for g in range(groups - 1)], U64)), len(hashes))


def requests(block: int, frame: pd.DataFrame, order: int, groups: int) -> Iterator[tuple]:
    """What a block asks of each group, and its own training counts: rows (n, group, block, tokens, packed)."""
    t = Tokens(frame["text"].tolist(), order)
    train = np.repeat(~frame["held_out"].to_numpy(bool), np.diff(t.offsets))
    for n, (grams, place) in enumerate(zip(t.grams, t.place, strict=True), 1):
        counts = np.bincount(place[train & (place >= 0)], minlength=len(grams))
        a = 0
        for g, b in enumerate(_group_edges(grams, groups).tolist()):
            if b > a:
                yield n, g, block, int(counts[a:b].sum()), _pack(grams[a:b], counts[a:b])
            a = b


def count_group(frame: pd.DataFrame) -> pd.DataFrame:
    """Total counts of a group's n-grams, returned to each block in the order of its request."""
    asked = [_unpack(x) for x in frame["packed"]]
    every, place = np.unique(np.concatenate([h for h, _ in asked]), return_inverse=True)
    counts = np.concatenate([c for _, c in asked]).astype(np.float64)  # whole numbers, exact up to 2**53
    totals = np.bincount(place, weights=counts, minlength=len(every))
    ends = starts(np.array([len(h) for h, _ in asked]))
    return frame[["n", "grp", "block"]].assign(
        counts=[_pack_counts(totals[place[x:y]]) for x, y in zip(ends, ends[1:], strict=False)])


def count_types(frame: pd.DataFrame) -> pd.DataFrame:
    """Distinct training tokens of a group of single tokens, and how often they occur."""
    if frame["n"].iloc[0] != 1:
        return pd.DataFrame({"types": [], "tokens": []})
    asked = [_unpack(x) for x in frame["packed"]]
    seen = np.concatenate([h[c > 0] for h, c in asked])
    return pd.DataFrame({"types": [len(np.unique(seen))], "tokens": [int(frame["tokens"].sum())]})


class Automaton:
    """States and arcs for the tokens of a block.

    ``fail_to`` and ``fail_weight`` have a failure arc for each state but 0, the empty context. ``keys`` are the arcs of the other states, ascending
    by state * tokens + token, with ``weight`` and ``target``; the arcs of state 0 are ``base`` and ``after``, by token.
    """

    def __init__(self, t: Tokens, counts: list[np.ndarray], tokens: int, types: int, docs: int, order: int, prior: float) -> None:
        seen = [c.astype(np.float64) for c in counts]
        self.order, self.width = order, max(len(t.grams[0]), 1)
        self.token = t.place[0]
        self.base = np.log10((seen[0] + 1) / (tokens + types + 1))
        passed, fail_to = [np.zeros(1)], [np.zeros(1, np.int64)]  # state by state: how often it was passed in training
        made = 1
        # By length of the context: the state of each of the block's n-grams, or of its longest end that is a state.
        state_of = [np.zeros(len(t.grams[0]), np.int64)]
        ends_in = [np.zeros(len(t.grams[0]), np.int64)]  # by order: the (n - 1)-gram that an n-gram ends in
        for n in range(1, order + 1):
            ends_in.append(t.place[n - 2][t.where[n - 1]] if n > 1 else np.zeros(len(t.grams[0]), np.int64))
            if n < order:
                shorter = state_of[n - 1][ends_in[n]] if n > 1 else np.zeros(len(t.grams[0]), np.int64)
                own = np.flatnonzero(seen[n - 1] > 0)
                state = shorter.copy()
                state[own] = made + np.arange(len(own))
                passed.append(seen[n - 1][own])
                fail_to.append(shorter[own])
                made += len(own)
                state_of.append(state)
        self.start = 0
        if order > 1 and docs:  # the start mark: passed once by each training document
            self.start, made = made, made + 1
            passed.append(np.array([float(docs)]))
            fail_to.append(np.zeros(1, np.int64))
        self.passed, self.fail_to = np.concatenate(passed), np.concatenate(fail_to)
        self.fail_weight = np.log10(prior / (self.passed + prior))
        self.after = state_of[1] if order > 1 else state_of[0]
        lower, keys, weights, targets = self.base, [], [], []
        for n in range(2, order + 1):
            arc = np.flatnonzero(seen[n - 1] > 0)
            last = t.where[n - 1][arc]
            opens = t.first[last] if n == 2 else np.zeros(len(arc), bool)
            source = np.where(opens, self.start, state_of[n - 1][t.place[n - 2][last - 1]])
            weight = np.full(len(seen[n - 1]), -np.inf)
            weight[arc] = np.log10((seen[n - 1][arc] + prior * 10.0 ** lower[ends_in[n][arc]]) / (self.passed[source] + prior))
            keys.append(source * self.width + self.token[last])
            weights.append(weight[arc])
            targets.append(state_of[n][arc] if n < order else state_of[n - 1][ends_in[n][arc]])
            lower = weight
        if keys:
            key = np.concatenate(keys)
            by_key = np.argsort(key, kind="stable")
            self.keys, self.weight, self.target = key[by_key], np.concatenate(weights)[by_key], np.concatenate(targets)[by_key]
        else:
            self.keys, self.weight, self.target = np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)

    def step(self, state: np.ndarray, token: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """New state and log10 weight of the way there for each lane: failure arcs until a state has an arc for the token."""
        state, total = state.copy(), np.zeros(len(state))
        new = np.empty(len(state), np.int64)
        lanes = np.arange(len(state))
        while len(lanes):
            inner = lanes[state[lanes] > 0]
            key = state[inner] * self.width + token[inner]
            at = np.minimum(np.searchsorted(self.keys, key), max(len(self.keys) - 1, 0))
            hit = self.keys[at] == key if len(self.keys) else np.zeros(len(inner), bool)
            gone = inner[hit]
            total[gone] += self.weight[at[hit]]
            new[gone] = self.target[at[hit]]
            outer = lanes[state[lanes] == 0]
            total[outer] += self.base[token[outer]]
            new[outer] = self.after[token[outer]]
            lanes = inner[~hit]
            total[lanes] += self.fail_weight[state[lanes]]
            state[lanes] = self.fail_to[state[lanes]]
        return new, total

    def walk(self, offsets: np.ndarray) -> np.ndarray:
        """Log10 probability of each document ``offsets[i]:offsets[i + 1]`` of the tokens."""
        lengths = np.diff(offsets)
        lanes = -(-lengths // LANE_TOKENS)
        doc = np.repeat(np.arange(len(lengths)), lanes)
        part = np.arange(len(doc)) - np.repeat(starts(lanes)[:-1], lanes)
        begin = offsets[doc] + part * LANE_TOKENS
        n = np.minimum(LANE_TOKENS, offsets[doc + 1] - begin)
        longest = np.argsort(-n, kind="stable")
        doc, part, begin, n = doc[longest], part[longest], begin[longest], n[longest]
        state = np.where(part == 0, self.start, 0)
        later = np.flatnonzero(part > 0)
        for back in range(self.order - 1, 0, -1):  # LANE_TOKENS tokens stand before: enough for any context
            state[later], _ = self.step(state[later], self.token[begin[later] - back])
        total = np.zeros(len(doc))
        for i in range(int(n.max(initial=0))):
            going = int(np.searchsorted(-n, -i, side="left"))  # lanes with more than i tokens
            state[:going], weight = self.step(state[:going], self.token[begin[:going] + i])
            total[:going] += weight
        return np.bincount(doc, weights=total, minlength=len(lengths))


def score_block(frame: pd.DataFrame, counts: list[np.ndarray], tokens: int, types: int, docs: int, order: int,
                prior: float) -> pd.DataFrame:
    """Scores of a block's documents from the training counts of its n-grams, by order."""
    t = Tokens(frame["text"].tolist(), order)
    machine = Automaton(t, counts, tokens, types, docs, order, prior)
    of_doc = lambda x: segment_sums(x, t.offsets)
    return pd.DataFrame({
        "doc_id": frame["doc_id"], "held_out": frame["held_out"], "n_tokens": np.diff(t.offsets),
        "n_known": of_doc((counts[0][t.place[0]] > 0).astype(np.float64)).astype(np.int64), "train_tokens": tokens,
        "base_score": of_doc(machine.base[t.place[0]]), "score": machine.walk(t.offsets)})


SCORES = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def score_documents(docs: DataFrame, order: int = ORDER, prior: float = PRIOR, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Scores of all rows of ``docs`` (doc_id, text, held_out) under the automaton learned from those not held out.

    A null text counts as empty and holds just the end token. Rows are scored one for one, repeated ones alike; a null id stays
    null; a null ``held_out`` counts as false. Without training rows every count is 0. ``docs`` is read twice: once for
    its size, once to score. Its rows must come in the same order each time, as those of a table do.
    """
    # The id travels as text: a long column with nulls would become floating point in pandas.
    slim = docs.selectExpr("cast(cast(doc_id as long) as string) as doc_id", "coalesce(cast(text as string), '') as text",
                           "coalesce(held_out, false) as held_out")
    size = slim.select(F.sum(F.length("text") + 64).alias("n"), F.count_if(~F.col("held_out")).alias("train")).first()
    blocks, training_docs = max(1, math.ceil((size["n"] or 0) / block_chars)), size["train"]
    groups = blocks * GROUPS_A_BLOCK
    dealt = slim.withColumn("block", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks)).cast("int"))

    def ask(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(list(requests(int(frame["block"].iloc[0]), frame, order, groups)),
                            columns=["n", "grp", "block", "tokens", "packed"])

    asked = dealt.groupBy("block").applyInPandas(ask, "n int, grp int, block int, tokens long, packed binary")
    totals = asked.groupBy("n", "grp").applyInPandas(count_types, "types long, tokens long").agg(
        F.struct(F.coalesce(F.sum("types"), F.lit(0)).alias("types"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens")).alias("all"))
    answered = (asked.groupBy("n", "grp").applyInPandas(count_group, "n int, grp int, block int, counts binary")
                .withColumn("totals", totals.scalar())
                .selectExpr("n", "grp", "block", "counts", "totals.types as types", "totals.tokens as tokens"))

    def score(frame: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        answers = answers.sort_values(["n", "grp"])
        counts = [np.concatenate([np.zeros(0, U64), *map(_unpack_counts, answers["counts"][answers["n"] == n])])
                  for n in range(1, order + 1)]
        return score_block(frame, counts, int(answers["tokens"].iloc[0]), int(answers["types"].iloc[0]), training_docs, order, prior)

    return (dealt.groupBy("block").cogroup(answered.groupBy("block"))
            .applyInPandas(score, SCORES.replace("doc_id long", "doc_id string")).withColumn("doc_id", F.col("doc_id").cast("long")))


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents, learned from those whose crc32 of the id as text, mod 7, is not 2."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text").withColumn("held_out", held_out("doc_id", 7, 2))
    return score_documents(docs)

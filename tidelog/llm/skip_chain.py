"""Personal data by a skip-chain conditional random field over the tokens that may hold it.

Base spans come from patterns and stay as they are.  The nodes of the field are the words with a digit
or an @; those in base spans are fixed to their kind.  Neighbouring nodes are linked, and so are distant
nodes with the same digits or the same core: each repeat with the one before it, and with the first
marked one of each kind, so that an unmarked repetition takes the label of the marked one however many
repetitions stand between them.  Loopy message passing runs over all texts of an Arrow slice at once, in
numpy, and goes on in each text until its own messages settle.  The factors
are trained piecewise: node, chain and skip factors each from the base labels of a bounded sample.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from dataclasses import dataclass
from functools import partial

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import appended, column, long, string

KINDS = ("email", "ip", "card", "phone")
LABELS = ("other", *KINDS)
#: Bounds of the sample that trains the factors: documents (those of the smallest hash; of them, the ones
#: with a digit or an @ are learned from), and bytes of a text.
MAX_DOCS, MAX_TEXT = 8000, 1 << 16
#: Share of the old message kept, and belief from which a span is added.
DAMPING, LEAST_BELIEF = 0.3, 0.9
#: Change below which a text's messages have settled; rounds after which the steps of those that swing are
#: halved, and after which no step that is left is above SETTLED.
SETTLED, CALM, ROUNDS = 1e-3, 100, 4000
#: Messages that are computed at a time, and tokens of texts that are taken together.
AT_ONCE, TOKENS = 1 << 15, 1 << 16
#: Digits or characters that make two tokens similar enough for a skip link.
LEAST_KEY = 4

SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# whole runs of digits: starting inside a run that failed can't succeed, so none is tried again
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_MAYBE = re.compile(r"[0-9@]")
_SPACE = re.compile(f"[{SPACES}]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if i % 2:
            n = n * 2 - 9 * (n > 4)
        total += n
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of local@domain, found from the @ so that long runs cost no retries."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            out.append((start, domain.end()))
            end = domain.end()
        else:
            end = at + 1  # a local part holds no @
        at = text.find("@", end)
    return out


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the pattern matches that pass their checks, by start, then kind as listed."""
    out = []
    if "@" in text:
        out += [(a, b, "email") for a, b in emails(text)]
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") for p in m.group().split(".")]
        if all(len(p) <= 3 and int(p or "0") <= 255 for p in parts):
            out.append((*m.span(), "ip"))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((*m.span(), "card"))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(c in "0123456789" for c in m.group()) <= 15:
                out.append((*m.span(), "phone"))
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def tokens(text: str) -> list[tuple[int, int]]:
    """The words (runs without the six ASCII spaces) that hold a digit or an @."""
    out, end = [], 0
    while found := _MAYBE.search(text, end):
        start = max(text.rfind(c, end, found.start()) for c in SPACES) + 1 or end
        after = _SPACE.search(text, found.end())
        stop = after.start() if after else len(text)
        out.append((start, stop))
        end = stop
    return out


def key_of(token: str) -> str:
    """What similar tokens have in common: their digits if there are enough, else their core."""
    digits = "".join(c for c in token if c in "0123456789")
    core = token.strip("\"'()[]{}<>.,;:!?*#$%&|=").casefold()
    best = digits if len(digits) >= LEAST_KEY else core
    return best if len(best) >= LEAST_KEY else ""


def shape(token: str) -> list[int]:
    """Indices of the features that are on, all below FEATURES."""
    digits = sum(c in "0123456789" for c in token)
    letters = sum(c.isalpha() for c in token)
    return [0, 1 + min(digits, 20), 22 + min(token.count("."), 4), 27 + min(token.count("-"), 3),
            31 + ("@" in token), 33 + token.startswith("+"), 35 + ("(" in token), 37 + (letters > 0) + (letters > digits),
            40 + min(len(token) // 4, 10), 51 + ("=" in token or '"' in token)]


#: Features of a token's own shape that are on, and all there are.
SHAPE, OWN = 10, 53
FEATURES = 3 * OWN  # own shape, and those of the neighbours that stand directly before and behind


@dataclass(frozen=True)
class Model:
    node: np.ndarray
    chain: np.ndarray
    skip: np.ndarray


class Graph:
    """Nodes, features and links of many texts.

    ``skip`` links successive repeats, from which the skip factor is learned; ``marked`` links free repeats
    to marked ones that ``skip`` does not reach directly.
    """

    def __init__(self, texts: list[str]):
        self.base = [base_spans(t) for t in texts]
        # flat arrays of machine numbers: a long text may be all numbers
        begins, ends, doc, fixed_as, near_before, shapes = array("q"), array("q"), array("i"), array("b"), array("b"), bytearray()
        skip, marked = array("q"), array("q")
        for d, text in enumerate(texts):
            found, last = tokens(text), {}
            repeats: dict[str, array] = {}
            first = len(begins)
            kinds = [[s for s in self.base[d] if s[2] == k] for k in KINDS]
            ahead = [0] * len(KINDS)
            for i, (start, stop) in enumerate(found):
                word = text[start:stop]
                fixed = -1
                for k, own in enumerate(kinds):  # spans of one kind do not overlap: one index each
                    while ahead[k] < len(own) and own[ahead[k]][1] <= start:
                        ahead[k] += 1
                    if fixed < 0 and ahead[k] < len(own) and own[ahead[k]][0] < stop:
                        fixed = k + 1
                fixed_as.append(fixed)
                shapes += bytes(shape(word))
                near_before.append(i > 0 and start - found[i - 1][1] == 1)
                if key := key_of(word):
                    if key in last and last[key] != first + i - 1:
                        skip.extend((last[key], first + i))
                    last[key] = first + i
                    repeats.setdefault(key, array("q")).append(first + i)
                begins.append(start)
                ends.append(stop)
                doc.append(d)
            for own in repeats.values():
                if len(own) == 1:
                    continue
                heads: dict[int, int] = {}  # place of the first marked repeat of each kind
                for at, i in enumerate(own):
                    if fixed_as[i] > 0:
                        heads.setdefault(fixed_as[i], at)
                for h in heads.values():
                    for at, i in enumerate(own):
                        if fixed_as[i] < 0 and (abs(at - h) > 1 or abs(own[h] - i) == 1):
                            marked.extend((min(own[h], i), max(own[h], i)))
        self.begins, self.ends = np.array(begins, np.int64), np.array(ends, np.int64)
        self.doc, self.fixed = np.array(doc, np.int32), np.array(fixed_as, np.int8)
        self.shapes = np.frombuffer(bytes(shapes), np.uint8).reshape(-1, SHAPE)
        self.near = np.flatnonzero(np.array(near_before, bool))  # nodes that stand directly behind another
        second = np.flatnonzero(self.doc[1:] == self.doc[:-1]) + 1
        self.chain = np.column_stack([second - 1, second])
        self.skip = np.array(skip, np.int64).reshape(-1, 2)
        self.marked = np.array(marked, np.int64).reshape(-1, 2)

    def __len__(self) -> int:
        return len(self.begins)

    def _features(self):
        """Nodes, and the nodes whose shapes are their features from a place of the weights on: their own, and those
        of the neighbours directly before and behind."""
        yield np.arange(len(self)), np.arange(len(self)), 0
        yield self.near, self.near - 1, OWN
        yield self.near - 1, self.near, 2 * OWN

    def scores(self, weights: np.ndarray) -> np.ndarray:
        out = np.zeros((len(self), len(LABELS)))
        for nodes, shown, place in self._features():
            for k in range(SHAPE):
                out[nodes] += weights[place + self.shapes[shown, k].astype(np.int64)]
        return out

    def sums(self, values: np.ndarray) -> np.ndarray:
        """For every feature the sum of the values of the nodes that have it."""
        out = np.zeros((FEATURES, values.shape[1]))
        for nodes, shown, place in self._features():
            for k in range(SHAPE):
                np.add.at(out, place + self.shapes[shown, k].astype(np.int64), values[nodes])
        return out


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def beliefs(graph: Graph, model: Model) -> np.ndarray:
    """Approximate label probabilities of every node by loopy sum-product message passing."""
    n = len(graph)
    unary = graph.scores(model.node)
    held = graph.fixed >= 0
    unary[held] = -1e6  # more than all links of a node that many repeats are linked to
    unary[held, graph.fixed[held].astype(np.int64)] = 0.0
    links = np.concatenate([graph.chain, graph.skip, graph.marked]).astype(np.int32)
    if n and len(links):
        m = len(links)
        # message e goes along link e, message e + m against it
        source, target = np.concatenate([links[:, 0], links[:, 1]]), np.concatenate([links[:, 1], links[:, 0]])
        of_skip = np.tile(np.arange(m) >= len(graph.chain), 2)
        factors = np.exp(np.stack([model.chain, model.chain.T, model.skip, model.skip.T]))
        which = (2 * of_skip + (np.arange(2 * m) >= m)).astype(np.int8)
        sent = np.zeros((2 * m, len(LABELS)))
        # each text stops by itself, so that its beliefs do not depend on the others of its slice
        doc = graph.doc[source]
        going = np.arange(2 * m, dtype=np.int32)
        damping = np.full(int(graph.doc[-1]) + 1, DAMPING)
        for turn in range(ROUNDS):
            total = unary.copy()
            for label in range(len(LABELS)):
                total[:, label] += np.bincount(target[going], sent[going, label], n)
            change = np.zeros(len(damping))
            new = np.empty((len(going), len(LABELS)))
            for i in range(0, len(going), AT_ONCE):
                own = going[i:i + AT_ONCE]
                into = total[source[own]] - sent[np.where(own < m, own + m, own - m)]
                into = np.exp(into - into.max(axis=1, keepdims=True))
                out = np.log(np.maximum(np.matmul(into[:, None, :], factors[which[own]])[:, 0, :], 1e-300))
                out -= _logsum(out, 1)[:, None]
                keep = damping[doc[own]][:, None]
                new[i:i + AT_ONCE] = keep * sent[own] + (1 - keep) * out
                np.maximum.at(change, doc[own], np.abs(new[i:i + AT_ONCE] - sent[own]).max(axis=1))
            sent[going] = new
            going = going[change[doc[going]] >= SETTLED]
            if not len(going):
                break
            if turn % CALM == CALM - 1:  # what still swings moves by ever smaller steps, until it settles
                damping[np.unique(doc[going])] = 1 - (1 - damping[np.unique(doc[going])]) / 2
        for label in range(len(LABELS)):
            unary[:, label] += np.bincount(target, sent[:, label], n)
    return np.exp(unary - _logsum(unary, 1)[:, None]) if n else unary


def train(texts: list[str]) -> Model:
    """Piecewise training: a logistic node factor, and log ratios of label pairs on either kind of link."""
    graph = Graph(texts)
    y = np.maximum(graph.fixed.astype(np.int64), 0)
    weights = np.zeros((FEATURES, len(LABELS)))
    if len(y):
        goal = np.eye(len(LABELS))[y]
        rate = 1.0 / np.maximum(graph.sums(np.ones((len(y), 1))), 5)
        for _ in range(300):
            s = graph.scores(weights)
            error = goal - np.exp(s - _logsum(s, 1)[:, None])
            weights += rate * (graph.sums(error) - 0.5 * weights)

    def ratios(links, prior):
        pairs = prior.astype(float)
        np.add.at(pairs, (y[links[:, 0]], y[links[:, 1]]), 1)
        pairs /= pairs.sum()
        return np.clip(np.log(pairs / (pairs.sum(1)[:, None] * pairs.sum(0)[None, :])), -4, 4)

    flat = np.ones((len(LABELS), len(LABELS)))
    # before any data, similar tokens share their label ten times as often as not
    return Model(weights, ratios(graph.chain, flat), ratios(graph.skip, flat + 9 * np.eye(len(LABELS))))


def added_spans(texts: list[str], graph: Graph, model: Model) -> list[list[tuple[int, int, str]]]:
    """Spans of free nodes that the field believes to be personal data; direct neighbours of a kind join."""
    out: list[list[tuple[int, int, str]]] = [[] for _ in texts]
    p = beliefs(graph, model)
    for i in np.flatnonzero((graph.fixed < 0) & (p[:, 1:].max(axis=1, initial=0) >= LEAST_BELIEF)):
        d, kind = int(graph.doc[i]), LABELS[1 + int(p[i, 1:].argmax())]
        start, stop = int(graph.begins[i]), int(graph.ends[i])
        word = texts[d][start:stop]
        trimmed = word.rstrip("\"']}>.,;:!?*#$%&|=" + ")" * ("(" not in word))
        stop, start = start + len(trimmed), start + len(trimmed) - len(trimmed.lstrip("\"'[{<.,;:!?*#$%&|="))
        if start >= stop:
            continue
        if out[d] and out[d][-1][2] == kind and start - out[d][-1][1] == 1:
            start = out[d].pop()[0]
        out[d].append((start, stop, kind))
    return out


def all_spans(texts: list[str], model: Model):
    # as many texts at a time as have some TOKENS tokens, by their digits; the rest follows by itself
    part, held = [], 0
    for i, text in enumerate(texts):
        part.append(text)
        held += sum(map(text.count, "0123456789@")) // 3
        if held >= TOKENS or i == len(texts) - 1:
            graph = Graph(part)
            for base, added in zip(graph.base, added_spans(part, graph, model)):
                yield base, sorted(base + added, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))
            part, held = [], 0


def joined(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def masked(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with every span, or run of overlapping spans, replaced by its first kind in brackets."""
    out, end = [], 0
    for a, b, kind in spans:
        if a >= end:
            out += [text[end:a], f"[{kind.upper()}]"]
        end = max(end, b)
    return "".join([*out, text[end:]])


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Train on a bounded sample of the documents that have a digit or an @, by hash of id and text."""
    text = column(text_col)
    # a share of the hashes that holds MAX_DOCS documents on average, so that tasks send no more than
    # the sample; the limit holds should many rows be equal
    share = min(1.0, MAX_DOCS / max(1, docs.count()))
    most = F.lit(min(2 ** 63 - 1, int(-2 ** 63 + share * 2 ** 64))).cast("long")
    rows = (docs.select(text.alias("text"), F.xxhash64(column(id_col), text).alias("hash"))
            .where((F.col("hash") <= most) & (F.octet_length("text") <= MAX_TEXT) & F.col("text").rlike("[0-9@]"))
            .orderBy("hash", "text").limit(2 * MAX_DOCS).collect())
    return train([r["text"] for r in rows])


def _start_spans(model: Model):
    def work(texts):
        texts = [t or "" for t in texts]
        found = list(all_spans(texts, model))
        counts = [[sum(s[2] == k for s in base) for base, _ in found] for k in KINDS]
        digests = [hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in found]
        return [*counts, digests, [joined(every) for _, every in found]]

    return work


def _start_mask(model: Model):
    def work(texts):
        found = all_spans([t or "" for t in texts], model)
        return [[None if t is None else masked(t, every) for t, (_, every) in zip(texts, found)]]

    return work


def detected(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Counts per kind and digest of the base spans, and all spans, of every whole text.

    A null text counts as empty: no spans.  Texts may be of any length.  Spans are given in code points,
    end exclusive, by start, then kind.  Equal texts in different slices get equal spans.  A kept column
    (all by default) named like a result is replaced.
    """
    results = [*[long(f"n_{k}") for k in KINDS], string("base_sha256"), string("spans")]
    return appended(docs, [text_col], docs.columns if keep is None else keep, results, partial(_start_spans, model))


def redacted(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows with all spans of their text masked; a null text stays null, other columns as they are."""
    out = appended(docs, [text_col], docs.columns, [string(text_col)], partial(_start_mask, model))
    return out.select(*[column(c) for c in docs.columns])

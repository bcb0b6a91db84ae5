"""Chinese-restaurant seating of a hierarchical Pitman-Yor model, sampled by Gibbs, many words at once.

Restaurants stand in three levels: a leaf for each preceding word, above it one for each class of such words,
above them the root, whose base is uniform over the vocabulary and one unknown word. A table of a restaurant is a customer of its parent.

Words are independent of each other given the restaurants' numbers of customers and tables, which are held
fixed in a sweep (:class:`Totals`); all arrays here hold the words of one batch. An entry is a word in a
restaurant. Seats are sampled as numbers of tables, a whole entry at a time: with ``mass`` the weight of a
new table times the parent's probability of the word, ``c`` customers sit at ``t`` tables with probability
in proportion to ``S(c, t) * mass ** t``, where S adds up all ways to share them out (generalised Stirling
numbers; a table of n gives ``(1 - d) (2 - d) ... (n - 1 - d)``). So the cost of a sweep goes with entries
and tables, not with customers. The parents' probabilities are drawn too, from their seats: given these,
the entries below are independent.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

import numpy as np

LEVELS = ("leaf", "mid", "root")
STRENGTH = {"leaf": 1.0, "mid": 1.0, "root": 1.0}
EXACT = 256           # customers up to which tables are drawn from the numbers S themselves
FEW = 30.0            # of more customers: expected tables below which their number is drawn as few among many
DRAWN_AT_ONCE = 1 << 21


KIND_BITS = 5  # of a context's id: the class of its word


@dataclass(frozen=True)
class Contexts:
    """A restaurant of its own for every preceding word, by 43 bits of its hash; ``ids`` (ascending) are those of some.

    A leaf is a place among ``ids``. ``common`` ids (ascending, up to 65,536) are those that are written in short.
    """

    ids: np.ndarray
    classes: int = 16
    common: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    @property
    def mids(self) -> int:
        return self.classes + 1

    @property
    def leaves(self) -> int:
        return len(self.ids)

    def leaf_of(self, kind: np.ndarray, words: np.ndarray) -> np.ndarray:
        """The contexts' ids."""
        return ((words >> np.uint64(64 - 43)) << np.uint64(KIND_BITS) | kind).astype(np.int64)

    def in_short(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of ascending ids: places among the common ones, and the others."""
        at = np.searchsorted(self.common, ids)
        short = np.append(self.common, -1)[at] == ids
        return at[short], ids[~short]

    def whole(self, short: np.ndarray, others: np.ndarray) -> np.ndarray:
        return np.sort(np.concatenate([self.common[short], others]))

    def kind_of(self, ids: np.ndarray) -> np.ndarray:
        return ids & ((1 << KIND_BITS) - 1)

    def mid_of(self, leaf: np.ndarray) -> np.ndarray:
        return self.kind_of(self.ids[leaf])

    def count(self, level: str) -> int:
        return {"leaf": self.leaves, "mid": self.mids, "root": 1}[level]

    def place(self, ids: np.ndarray) -> np.ndarray:
        """The leaf of each of some contexts, or the number of leaves."""
        at = np.searchsorted(self.ids, ids)
        found = np.append(self.ids, -1)[at] == ids
        return np.where(found, at, len(self.ids))


@dataclass(frozen=True)
class Rooms:
    """Contexts hashed into few rooms, all numbered: classes of the last word (0: none), and rooms for the words of each.

    For samplers that keep every restaurant in arrays.
    """

    classes: int = 16
    words: int = 64

    @property
    def mids(self) -> int:
        return self.classes + 1

    @property
    def leaves(self) -> int:
        return self.mids * self.words

    def leaf_of(self, kind: np.ndarray, words: np.ndarray) -> np.ndarray:
        return (kind * np.uint64(self.words) + (words >> np.uint64(20)) % np.uint64(self.words)).astype(np.int64)

    def mid_of(self, leaf: np.ndarray) -> np.ndarray:
        return leaf // self.words

    def count(self, level: str) -> int:
        return {"leaf": self.leaves, "mid": self.mids, "root": 1}[level]


@dataclass
class Totals:
    """Customers and tables of every restaurant, discounts of the levels, size of the vocabulary.

    ``learned`` tokens, where the leaf restaurants are not all.
    """

    customers: dict[str, np.ndarray]
    tables: dict[str, np.ndarray]
    discount: dict[str, float]
    vocabulary: int
    rooms: Rooms | Contexts
    learned: int | None = None

    @staticmethod
    def guess(customers_leaf: np.ndarray, vocabulary: int, rooms: Rooms) -> "Totals":
        """Before anything is seated: half as many tables as customers at every level."""
        return Totals.guessed(customers_leaf, customers_leaf.reshape(rooms.mids, rooms.words).sum(axis=1), vocabulary, rooms)

    @staticmethod
    def guessed(customers_leaf: np.ndarray, by_class: np.ndarray, vocabulary: int, rooms: Rooms | Contexts) -> "Totals":
        """:meth:`guess`, given all leaf customers of each class."""
        customers = {"leaf": customers_leaf.astype(float), "mid": by_class / 2, "root": np.array([by_class.sum() / 4])}
        return Totals(customers, {k: v / 2 for k, v in customers.items()}, dict.fromkeys(LEVELS, 0.75), vocabulary, rooms,
                      int(by_class.sum()))

    def of_range(self, ids: np.ndarray, customers: np.ndarray, tables: np.ndarray | None) -> "Totals":
        """With the leaf restaurants of some contexts; before anything is seated, half as many tables as customers."""
        leaf = customers.astype(float)
        return replace(self, customers={**self.customers, "leaf": leaf}, rooms=replace(self.rooms, ids=ids),
                       tables={**self.tables, "leaf": leaf / 2 if tables is None else tables.astype(float)})

    def new_mass(self, level: str) -> np.ndarray:
        """Weight of a new table, before the parent's probability."""
        return STRENGTH[level] + self.discount[level] * self.tables[level]

    def weight(self, level: str) -> np.ndarray:
        return STRENGTH[level] + self.customers[level]

    def backoff(self, level: str) -> np.ndarray:
        return self.new_mass(level) / self.weight(level)

    @property
    def base(self) -> float:
        return 1.0 / (self.vocabulary + 1)


def log_ways(discount: float, most: int) -> np.ndarray:
    """``log S(c, t)`` for ``1 <= t <= c <= most``; a customer joins one of t tables of c in ``c - t d`` ways."""
    out = np.full((most + 1, most + 1), -np.inf)
    out[1, 1] = 0.0
    t = np.arange(most + 1)
    with np.errstate(divide="ignore"):
        for c in range(1, most):
            joined = out[c] + np.log(np.maximum(c - discount * t, 0))
            out[c + 1, 1:] = np.logaddexp(joined[1:], out[c, :-1])
    return out


def _tilted(customers: np.ndarray, mass: np.ndarray, d: float):
    """Mean and variance of the number of tables of many customers.

    Without the condition on their total, tables are a Poisson number with ``mass (1 - y^d) / d`` expected, and
    sizes independent; ``y`` is chosen so that ``customers`` are expected in all. The number of tables, given
    that total, then has about this mean and variance (a saddle point).
    """
    low, high = np.full(len(customers), -700.0), np.full(len(customers), -1e-12)  # of log y
    target = np.log(customers) - np.log(mass)
    for _ in range(60):
        middle = (low + high) / 2
        more = np.log(-np.expm1(middle)) + (d - 1) * middle > target
        low, high = np.where(more, middle, low), np.where(more, high, middle)
    y = np.exp(low)
    mean = mass * -np.expm1(d * low) / d
    return mean, np.maximum(mean - customers / (1 + (1 - y) * (1 - d) / np.maximum(y, 1e-300)), 0)


def draw_tables(rng, customers: np.ndarray, mass: np.ndarray, discount: float, ways: np.ndarray) -> np.ndarray:
    """The number of tables of each entry, given its customers and the mass of a new table.

    Up to ``EXACT`` customers by the numbers S (``ways``). Of more, a large number of tables is normal
    (:func:`_tilted`), and a small one, with ``S(c, t + 1) / S(c, t)`` about ``(1 - c^-d) / (d t)``, one more than
    a Poisson number.
    """
    out = np.ones(len(customers), np.int64)
    mass = np.maximum(mass, 1e-300)
    few = np.flatnonzero((customers > 1) & (customers <= EXACT))
    few = few[np.argsort(customers[few], kind="stable")]
    sizes = customers[few]
    for c in np.unique(sizes):
        own = few[slice(*np.searchsorted(sizes, [c, c + 1]))]
        t = np.arange(1, c + 1)
        for at in range(0, len(own), max(1, DRAWN_AT_ONCE // int(c))):
            some = own[at:at + max(1, DRAWN_AT_ONCE // int(c))]
            w = ways[c, 1:c + 1][None, :] + np.log(mass[some])[:, None] * t[None, :]
            w = np.cumsum(np.exp(w - w.max(axis=1, keepdims=True)), axis=1)
            out[some] = 1 + (w < (rng.random(len(some)) * w[:, -1])[:, None]).sum(axis=1)
    many = np.flatnonzero(customers > EXACT)
    if len(many):
        c, m = customers[many].astype(float), mass[many]
        mean, variance = _tilted(c, m, discount)
        rate = m * -np.expm1(-discount * np.log(c)) / discount
        normal = np.rint(mean + np.sqrt(variance) * rng.standard_normal(len(many)))
        small = 1 + rng.poisson(np.minimum(rate, 4 * FEW))
        out[many] = np.clip(np.where(rate < FEW, small, normal), 1, c).astype(np.int64)
    return out


def draw_measure(rng, customers: np.ndarray, tables: np.ndarray, prior: np.ndarray, discount: float) -> np.ndarray:
    """A restaurant's share of each word (times its weight), given the word's seats and what the parent adds.

    Tables of n customers have independent shares, gamma distributed by ``n - d``; what no table has yet is a
    sum of small shares of mean ``prior`` and variance ``prior (1 - d)``, drawn as the gamma variable of both.
    """
    rest = rng.standard_gamma(prior / (1 - discount)) * (1 - discount)
    return np.maximum(rng.standard_gamma(np.maximum(customers - discount * tables, 0)) + rest, 1e-300)


class Level:
    """Entries with their restaurants, the entries above them, customers and tables."""

    def __init__(self, room: np.ndarray, parent: np.ndarray | None):
        self.room, self.parent = room, parent
        self.customers = self.tables = np.zeros(len(room), np.int64)


class Seating:
    """All restaurants' seats for a batch of words: ``word`` (0, 1, ... ascending), ``leaf`` and ``count`` per entry.

    Tables are those that ``take(level, entries)`` tells of an earlier sweep, or drawn with the word's share of
    all tokens for the parents' probabilities, which are not known yet.
    """

    def __init__(self, word: np.ndarray, leaf: np.ndarray, count: np.ndarray, totals: Totals, rng, take=None):
        self.totals, self.rng = totals, rng
        self.word, self.words = word, int(word[-1]) + 1 if len(word) else 0
        mids = totals.rooms.mids
        keys, to_mid = np.unique(word * mids + totals.rooms.mid_of(leaf), return_inverse=True)
        self.mid_word = keys // mids
        self.leaf, self.mid = Level(leaf, to_mid), Level(keys % mids, self.mid_word)
        self.root = Level(np.zeros(self.words, np.int64), None)
        self.total = np.bincount(word, count, self.words).astype(np.int64)
        self.leaf.customers = count
        self._ways: dict[float, np.ndarray] = {}
        if take is not None:
            for name in LEVELS:
                getattr(self, name).tables = take(name, len(getattr(self, name).room))
            self.mid.customers, self.root.customers = self._up(self.leaf, len(keys)), self._up(self.mid, self.words)
            return
        learned = totals.customers["leaf"].sum() if totals.learned is None else totals.learned
        share = np.maximum(self.total / max(1.0, float(learned)), totals.base)
        self._seat(share[self.mid_word], share)

    @staticmethod
    def _up(level: Level, entries: int) -> np.ndarray:
        return np.bincount(level.parent, level.tables, entries).astype(np.int64)

    def _drawn(self, name: str, parent: np.ndarray) -> np.ndarray:
        d, level = self.totals.discount[name], getattr(self, name)
        if d not in self._ways:
            self._ways[d] = log_ways(d, EXACT)
        return draw_tables(self.rng, level.customers, self.totals.new_mass(name)[level.room] * parent, d, self._ways[d])

    def _seat(self, mid: np.ndarray, root: np.ndarray) -> None:
        """Tables of all levels from below, given the probabilities of the mid and root entries."""
        self.leaf.tables = self._drawn("leaf", mid[self.leaf.parent])
        self.mid.customers = self._up(self.leaf, len(self.mid_word))
        self.mid.tables = self._drawn("mid", root[self.mid_word])
        self.root.customers = self._up(self.mid, self.words)
        self.root.tables = self._drawn("root", np.full(self.words, self.totals.base))

    def sweep(self) -> None:
        """Every customer of every word is seated anew once: all entries' tables are drawn afresh."""
        t = self.totals
        prior = np.full(self.words, t.new_mass("root")[0] * t.base)
        root = draw_measure(self.rng, self.root.customers, self.root.tables, prior, t.discount["root"]) / t.weight("root")[0]
        room = self.mid.room
        prior = t.new_mass("mid")[room] * root[self.mid_word]
        mid = draw_measure(self.rng, self.mid.customers, self.mid.tables, prior, t.discount["mid"]) / t.weight("mid")[room]
        self._seat(mid, root)

    def _seated(self, level: Level, name: str) -> np.ndarray:
        """Weight of sitting at any old table."""
        return level.customers - self.totals.discount[name] * level.tables

    def p_root(self) -> np.ndarray:
        t = self.totals
        return (self._seated(self.root, "root") + t.new_mass("root")[0] * t.base) / t.weight("root")[0]

    def p_mid(self) -> np.ndarray:
        t, room = self.totals, self.mid.room
        return (self._seated(self.mid, "mid") + t.new_mass("mid")[room] * self.p_root()[self.mid_word]) / t.weight("mid")[room]

    def p_leaf(self) -> np.ndarray:
        t, room = self.totals, self.leaf.room
        return (self._seated(self.leaf, "leaf") + t.new_mass("leaf")[room] * self.p_mid()[self.leaf.parent]) / t.weight("leaf")[room]

    def counted(self) -> dict[str, tuple]:
        """By level: customers and tables of each restaurant, and entries with one and with two customers."""
        out = {}
        for name in LEVELS:
            level: Level = getattr(self, name)
            n = self.totals.rooms.count(name)
            out[name] = (np.bincount(level.room, level.customers, n), np.bincount(level.room, level.tables, n),
                         int((level.customers == 1).sum()), int((level.customers == 2).sum()))
        return out

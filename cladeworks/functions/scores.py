"""Log-likelihoods of pattern blocks with their derivatives by branch lengths, in NumPy: mixtures of classes, processes by branch label."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from cladeworks.functions.codons import CODONS, code_of
from cladeworks.functions.statemodels import AMINO_ACIDS, codon_steps
from cladeworks.functions.substitution import AMBIGUOUS, MODELS, Model, discrete_gamma, exchange_matrix
from cladeworks.sources.newick import Node, parse_newick

BASES = "TCAG"


@dataclass
class SiteClass:
    """A class of sites: its share, its relative rate, the process on branches of each label, and frequencies at the root (None: those of the first process)."""

    share: float
    rate: float
    processes: tuple
    root: np.ndarray | None = None


class General:
    """Transition probabilities of any rate matrix, reversible or not, with its stationary frequencies."""

    def __init__(self, q: np.ndarray):
        n = len(q)
        self.freqs = np.linalg.lstsq(np.vstack([q.T, np.ones(n)]), np.append(np.zeros(n), 1.0), rcond=None)[0]
        q = q / -(self.freqs @ np.diag(q))
        self.values, self.left = np.linalg.eig(q)
        self.right = np.linalg.inv(self.left)

    def p(self, t: float) -> np.ndarray:
        return np.real((self.left * np.exp(self.values * t)) @ self.right)


def branch_labels(nodes: list[Node]) -> list[int]:
    """The label of the branch above each node: ``#`` marks one branch, ``$`` a whole clade with its stem; # goes before $, an inner $ before an outer one."""
    clades, out = [0] * len(nodes), [0] * len(nodes)
    for n in nodes:  # fathers come first
        clades[n.node_id] = int(n.clade) if n.clade is not None else clades[n.father] if n.father is not None else 0
        out[n.node_id] = int(n.label) if n.label is not None else clades[n.node_id]
    return out


def alphabet_of(kind: str, code: str = "universal") -> list[str]:
    """The states of ``bases``, ``proteins`` or ``codons``."""
    if kind == "codons":
        aa = code_of(code)
        return [c for c in CODONS if aa[c] != "*"]
    return list(AMINO_ACIDS if kind == "proteins" else BASES)


def tip_vectors(patterns: list[str], taxa: int, alphabet: list[str]) -> list[np.ndarray]:
    """For each taxon (patterns x states): 1 for what the character allows. Codons of known bases are one state, others all."""
    width = len(alphabet[0])
    at = {s: k for k, s in enumerate(alphabet)}
    rows = [np.ones(len(alphabet))]
    known: dict[str, int] = {}
    for s in {p[k : k + width] for p in patterns for k in range(0, taxa * width, width)}:
        allowed = [at[s]] if s in at else [at[b] for b in AMBIGUOUS.get(s, "")] if alphabet == list(BASES) else []
        if allowed:
            known[s] = len(rows)
            rows.append(np.isin(np.arange(len(alphabet)), allowed).astype(float))
    table = np.array(rows)
    return [table[[known.get(p[k * width : (k + 1) * width], 0) for p in patterns]] for k in range(taxa)]


def scaled(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    top = np.maximum(x.max(1), 1e-300)
    return x / top[:, None], np.log(top)


def one_class(nodes: list[Node], tips: list[np.ndarray], labels: list[int], lengths: np.ndarray, c: SiteClass, derive: bool):
    """(lnf, first, second): for each pattern ln f, and f'/f and f''/f by each branch (column k: the branch above node k + 1)."""
    n = len(tips[0])
    moves = [None] + [c.processes[labels[k]].p(lengths[k] * c.rate) for k in range(1, len(nodes))]
    below, carried, logs = [None] * len(nodes), [None] * len(nodes), np.zeros(n)
    for node in reversed(nodes):
        k = node.node_id
        if node.sons:
            part = carried[node.sons[0]]
            for s in node.sons[1:]:
                part = part * carried[s]
            below[k], more = scaled(part)
            logs += more
        else:
            below[k] = tips[int(node.name) - 1]
        if k:
            carried[k] = below[k] @ moves[k].T
    freqs = c.processes[0].freqs if c.root is None else c.root
    total = below[0] @ freqs
    lnf = np.log(np.maximum(total, 1e-300)) + logs
    if not derive:
        return lnf, None, None
    above = [None] * len(nodes)
    above[0] = np.tile(freqs, (n, 1))
    first, second = np.empty((n, len(nodes) - 1)), np.empty((n, len(nodes) - 1))
    for node in nodes:
        for s in node.sons:
            outside = above[node.node_id]
            for o in node.sons:
                if o != s:
                    outside = outside * carried[o]
            outside, _ = scaled(outside)
            m = c.processes[labels[s]]
            left, right = outside @ m.left, below[s] @ m.right.T
            decay = m.values * c.rate
            power = left * right * np.exp(decay * lengths[s])
            # of processes that aren't reversible, complex parts cancel
            f = np.maximum(np.real(power.sum(1)), 1e-300)
            first[:, s - 1], second[:, s - 1] = np.real(power @ decay) / f, np.real(power @ decay**2) / f
            if nodes[s].sons:
                above[s] = outside @ moves[s]
    return lnf, first, second


def mixture(nodes, tips, labels, lengths, classes: list[SiteClass], derive: bool = True):
    """(lnf, d, dd, by_class): ln of each pattern's probability, its first and second derivatives by branch lengths, and ln f of each class."""
    found = [one_class(nodes, tips, labels, lengths, c, derive) for c in classes]
    by_class = np.stack([f for f, _, _ in found], 1)
    shares = np.array([c.share for c in classes])
    top = by_class.max(1)
    weights = np.exp(by_class - top[:, None]) * shares
    total = weights.sum(1)
    lnf = top + np.log(np.maximum(total, 1e-300))
    if not derive:
        return lnf, None, None, by_class
    weights /= np.maximum(total, 1e-300)[:, None]
    d = sum(weights[:, k, None] * first for k, (_, first, _) in enumerate(found))
    dd = sum(weights[:, k, None] * second for k, (_, _, second) in enumerate(found)) - d * d
    return lnf, d, dd, by_class


@dataclass
class Shared:
    """A block of patterns by what they have in common: for each node the distinct parts of patterns below it.

    ``rows``: an inner node's parts as places in its sons' tables (parts x sons). ``states``: a tip's table, what each part allows
    (parts x states). ``place``: the whole patterns' places in the root's table.
    """

    nodes: list[Node]
    rows: list[np.ndarray | None]
    states: list[np.ndarray | None]
    place: np.ndarray


def shared_parts(nodes: list[Node], patterns: list[str], alphabet: list[str]) -> Shared:
    """The parts of ``patterns`` at each node; states as ``tip_vectors`` has them."""
    width, at = len(alphabet[0]), {s: k for k, s in enumerate(alphabet)}
    letters = np.array(patterns, dtype=str).reshape(-1, 1).view("U1").reshape(len(patterns), -1)
    rows, states, place = [None] * len(nodes), [None] * len(nodes), [None] * len(nodes)
    for n in reversed(nodes):
        k = n.node_id
        if not n.sons:
            first = (int(n.name) - 1) * width
            codes = letters[:, first : first + width].copy().view(f"U{width}")[:, 0]
            found, back = np.unique(codes, return_inverse=True)
            allowed = [[at[s]] if s in at else [at[b] for b in AMBIGUOUS.get(s, "")] if alphabet == list(BASES) else [] for s in map(str, found)]
            table = np.array([np.isin(np.arange(len(at)), a) if a else np.ones(len(at), bool) for a in allowed])
            # what allows the same is the same part
            table, merged = np.unique(table, axis=0, return_inverse=True)
            states[k], place[k] = table.astype(float), merged.ravel()[back.ravel()]
            continue
        joined = place[n.sons[0]].astype(np.int64)
        for s in n.sons[1:]:  # no product outgrows 64 bits: parts are numbered anew behind each son
            joined = np.unique(joined * (place[s].max() + 1) + place[s], return_inverse=True)[1].ravel()
        _, first, back = np.unique(joined, return_index=True, return_inverse=True)
        rows[k], place[k] = np.stack([place[s][first] for s in n.sons], 1), back.ravel()
    return Shared(nodes, rows, states, place[0])


#: Cells of a table (parts x states) that are multiplied at once.
CELLS = 1 << 16


def shared_class(b: Shared, labels: list[int], lengths: np.ndarray, c: SiteClass, seed=None):
    """(lnf of the root's parts, None), or with ``seed`` (lnf -> weight of each part) also the weighted sum of lnf's derivatives by each branch.

    A part that many patterns have is moved along its branch once. Derivatives are handed down from the root to parts, where those of all
    patterns with a part are added up before they are moved on.
    """
    nodes, size = b.nodes, len(c.processes[0].freqs)
    moves = [None] + [c.processes[labels[k]].p(lengths[k] * c.rate) for k in range(1, len(nodes))]
    freqs = c.processes[0].freqs if c.root is None else c.root
    step = max(1, CELLS // size)
    below, carried, logs, tops = [None] * len(nodes), [None] * len(nodes), [None] * len(nodes), [None] * len(nodes)
    total = np.empty(len(b.rows[0]))
    for node in reversed(nodes):
        k = node.node_id
        if node.sons:
            rows = b.rows[k]
            tops[k] = np.empty(len(rows))
            if k:
                below[k] = np.empty((len(rows), size))
            for a in range(0, len(rows), step):
                part = product([carried[s] for s in node.sons], rows[a : a + step])
                top = np.maximum(part.max(1), 1e-300)
                tops[k][a : a + step] = top
                if k:
                    below[k][a : a + step] = part / top[:, None]
                else:
                    total[a : a + step] = part @ freqs / top
            logs[k] = np.log(tops[k]) + sum(logs[s][rows[:, j]] for j, s in enumerate(node.sons) if logs[s] is not None)
        else:
            below[k] = b.states[k]
        if k:
            carried[k] = below[k] @ moves[k].T
    lnf = np.log(np.maximum(total, 1e-300)) + logs[0]
    if seed is None:
        return lnf, None
    weight = seed(lnf) / np.maximum(total, 1e-300)
    inner, slopes = [None] * len(nodes), np.zeros(len(nodes) - 1)
    for node in nodes:
        if not node.sons:
            continue
        k, rows = node.node_id, b.rows[node.node_id]
        for j, s in enumerate(node.sons):
            order = np.argsort(rows[:, j], kind="stable")
            handed = np.zeros_like(carried[s])
            for a in range(0, len(rows), step):
                some = order[a : a + step]
                own = weight[some, None] * freqs if k == 0 else inner[k][some]
                own = own / tops[k][some, None]
                for i, o in enumerate(node.sons):
                    if i != j:
                        own = own * carried[o][rows[some, i]]
                at = rows[some, j]
                begin = np.flatnonzero(np.diff(at, prepend=-1))
                handed[at[begin]] += np.add.reduceat(own, begin, axis=0)
            m = c.processes[labels[s]]
            decay = m.values * c.rate
            slope = np.real((m.left * (decay * np.exp(decay * lengths[s]))) @ m.right)
            slopes[s - 1] = (handed * (below[s] @ slope.T)).sum()
            if nodes[s].sons:
                inner[s] = handed @ moves[s]
        inner[k] = None
    return lnf, slopes


def product(tables: list[np.ndarray], rows: np.ndarray) -> np.ndarray:
    out = tables[0][rows[:, 0]]
    for j, t in enumerate(tables[1:], 1):
        out = out * t[rows[:, j]]
    return out


def shared_lnf(b: Shared, labels: list[int], lengths: np.ndarray, classes: list[SiteClass]) -> np.ndarray:
    """ln of the probability of each of the root's parts; ``place`` leads from patterns to parts."""
    return mixed_lnf(np.stack([shared_class(b, labels, lengths, c)[0] for c in classes], 1), classes)


def mixed_lnf(by_class: np.ndarray, classes: list[SiteClass]) -> np.ndarray:
    top = by_class.max(1)
    return top + np.log(np.maximum(np.exp(by_class - top[:, None]) @ np.array([c.share for c in classes]), 1e-300))


def shared_slopes(b: Shared, labels: list[int], lengths: np.ndarray, classes: list[SiteClass], weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ln f of the root's parts, the sum of their ``weight`` times its derivatives by each branch length)."""
    lnf = shared_lnf(b, labels, lengths, classes)
    slopes = [shared_class(b, labels, lengths, c, lambda own, c=c: weight * c.share * np.exp(own - lnf))[1] for c in classes]
    return lnf, sum(slopes)


def codon_rates(kappa: float, omega: float, freqs: np.ndarray, code: str) -> np.ndarray:
    _, (i, j, transition, synonymous) = codon_steps(code)[0], codon_steps(code)[1].T
    q = np.zeros((len(freqs), len(freqs)))
    q[i, j] = freqs[j] * np.where(transition == 1, kappa, 1.0) * np.where(synonymous == 1, 1.0, omega)
    np.fill_diagonal(q, -q.sum(1))
    return q


def beta_quantiles(p: float, q: float, classes: int) -> np.ndarray:
    """The middles of equally likely parts of a beta distribution, from its cumulated density on a fine grid."""
    u = (np.arange(20_000) + 0.5) / 20_000
    x = u * u * (3 - 2 * u)  # dense at both ends, where the density may be infinite
    width = 6 * u * (1 - u) / 20_000
    mass = np.exp((p - 1) * np.log(x) + (q - 1) * np.log1p(-x)) * width
    total = np.cumsum(mass)
    return np.interp((np.arange(classes) + 0.5) / classes, (total - mass / 2) / total[-1], x)


#: Classes that a beta distribution of omega is cut into.
BETA_CLASSES = 10
#: (bounds, start) of the free parameters of each codon model, kappa first. Shares are of what earlier shares leave; {labels} models have an omega for each label.
KAPPA, SHARE, SMALL, LARGE, ANY = (0.05, 100.0), (1e-3, 0.999), (1e-4, 0.9999), (1.0001, 50.0), (1e-4, 50.0)
CODON_MODELS = {
    "M0": ([KAPPA, ANY], [2, 0.4]),
    "M1a": ([KAPPA, SHARE, SMALL], [2, 0.7, 0.1]),
    "M2a": ([KAPPA, SHARE, SHARE, SMALL, LARGE], [2, 0.7, 0.7, 0.1, 2.5]),
    "M3": ([KAPPA, SHARE, SHARE, ANY, ANY, ANY], [2, 0.5, 0.6, 0.1, 0.6, 2.0]),
    "M7": ([KAPPA, (0.05, 50.0), (0.05, 50.0)], [2, 0.5, 1.5]),
    "M8": ([KAPPA, SHARE, (0.05, 50.0), (0.05, 50.0), LARGE], [2, 0.9, 0.5, 1.5, 2.5]),
    "branch": ([KAPPA], [2]),
    "A": ([KAPPA, SHARE, SHARE, SMALL, LARGE], [2, 0.7, 0.7, 0.1, 2.5]),
    "A_null": ([KAPPA, SHARE, SHARE, SMALL], [2, 0.7, 0.7, 0.1]),
    "C": ([KAPPA, SHARE, SHARE, SMALL], [2, 0.5, 0.5, 0.1]),
    "D": ([KAPPA, SHARE, SHARE, SMALL, ANY], [2, 0.5, 0.5, 0.1, 0.8]),
}
#: Models with an omega of its own for each branch label, behind the other parameters.
BY_LABEL = ("branch", "C", "D")


def codon_parameters(model: str, labels: int) -> tuple[np.ndarray, np.ndarray]:
    bounds, start = CODON_MODELS[model]
    more = labels if model in BY_LABEL else 0
    return np.array([*bounds, *[ANY] * more], float), np.array([*start, *[0.4 + 0.2 * k for k in range(more)]], float)


def omega_classes(model: str, x: np.ndarray, labels: int) -> list[tuple[float, list[float]]]:
    """(share, omega on branches of each label) of each class of sites; ``x`` begins with kappa.

    branch: one class, an omega a label. A: sites may turn from omega below or of one to a larger one on branches with a label
    (A_null: to one). C: omega below one, one, and one that differs by label; D: two free ones, and one that differs by label.
    """
    same = lambda w: [w] * labels
    if model == "M0":
        return [(1.0, same(x[1]))]
    if model == "branch":
        return [(1.0, list(x[1 : 1 + labels]))]
    if model in ("M7", "M8"):
        p, q = x[1:3] if model == "M7" else x[2:4]
        share = 1.0 if model == "M7" else x[1]
        beta = [(share / BETA_CLASSES, same(w)) for w in beta_quantiles(p, q, BETA_CLASSES)]
        return beta if model == "M7" else [*beta, (1 - share, same(x[4]))]
    if model == "M1a":
        return [(x[1], same(x[2])), (1 - x[1], same(1.0))]
    second = (1 - x[1]) * x[2]
    rest = 1 - x[1] - second
    if model == "M2a":
        return [(x[1], same(x[3])), (second, same(1.0)), (rest, same(x[4]))]
    if model == "M3":
        return [(x[1], same(x[3])), (second, same(x[4])), (rest, same(x[5]))]
    if model in ("A", "A_null"):
        # x[1]: the share of the first two classes, x[2]: of these, the share of the conserved one; the others divide alike
        high = x[4] if model == "A" else 1.0
        turned = lambda w: [w, *[high] * (labels - 1)]
        kept, gone = x[1], 1 - x[1]
        return [(kept * x[2], same(x[3])), (kept * (1 - x[2]), same(1.0)), (gone * x[2], turned(x[3])), (gone * (1 - x[2]), turned(1.0))]
    middle = 1.0 if model == "C" else x[4]
    own = list(x[len(CODON_MODELS[model][0]) :])
    return [(x[1], same(x[3])), (second, same(middle)), (rest, own)]


def codon_classes(model: str, x: np.ndarray, freqs: np.ndarray, labels: int = 1, code: str = "universal") -> list[SiteClass]:
    """Classes of sites whose branch lengths are changes a codon, on the mean over classes, on branches of each label."""
    found = omega_classes(model, x, labels)
    rates: dict[float, np.ndarray] = {}
    for _, omegas in found:
        for w in omegas:
            if w not in rates:
                rates[w] = codon_rates(x[0], w, freqs, code)
    pace = {w: -(freqs @ np.diag(q)) for w, q in rates.items()}
    scales = [sum(share * pace[omegas[k]] for share, omegas in found) for k in range(labels)]
    made: dict[tuple, Model] = {}
    for _, omegas in found:
        for k, w in enumerate(omegas):
            if (w, scales[k]) not in made:
                made[w, scales[k]] = Model(0, freqs, rates[w] / scales[k])
    return [SiteClass(share, 1.0, tuple(made[w, scales[k]] for k, w in enumerate(omegas))) for share, omegas in found]


#: Models of bases that aren't reversible, or not the same on all branches. UNREST: eleven rates beside the one from G to A;
#: NH: on branches of each label HKY85 with a kappa and frequencies of its own, and frequencies at the root.
PLACES = [(i, j) for i in range(4) for j in range(4) if i != j]


def shares_of(ratios: np.ndarray) -> np.ndarray:
    """Four frequencies from their ratios to the last."""
    x = np.append(ratios, 1.0)
    return x / x.sum()


def general_parameters(model: str, labels: int) -> tuple[np.ndarray, np.ndarray]:
    if model == "UNREST":
        return np.tile([[0.01, 50.0]], (11, 1)), np.ones(11)
    return np.tile([[0.02, 50.0]], (4 * labels + 3, 1)), np.array([2.0, 1.0, 1.0, 1.0] * labels + [1.0] * 3)


def general_class(model: str, x: np.ndarray, labels: int) -> SiteClass:
    if model == "UNREST":
        q = np.zeros((4, 4))
        for (i, j), r in zip(PLACES, [*x[:11], 1.0], strict=True):
            q[i, j] = r
        np.fill_diagonal(q, -q.sum(1))
        return SiteClass(1.0, 1.0, (General(q),) * labels)
    made = []
    for k in range(labels):
        freqs = shares_of(x[4 * k + 1 : 4 * k + 4])
        made.append(Model(0, freqs, exchange_matrix("HKY85", x[4 * k : 4 * k + 1], freqs)))
    return SiteClass(1.0, 1.0, tuple(made), shares_of(x[4 * labels : 4 * labels + 3]))


@dataclass
class Spec:
    """What is fitted: ``kind`` of states, ``model``, classes of a discrete gamma distribution of rates, genetic code, exchange rates of amino acids."""

    kind: str = "bases"
    model: str = "JC69"
    gamma: int = 1
    code: str = "universal"
    exchange: list | None = None

    def parameters(self, labels: int) -> tuple[np.ndarray, np.ndarray]:
        """(bounds, start) of what is free beside branch lengths; alpha comes last."""
        if self.kind == "codons":
            bounds, start = codon_parameters(self.model, labels)
        elif self.model in ("UNREST", "NH"):
            bounds, start = general_parameters(self.model, labels)
        else:
            free = MODELS[self.model][0] if self.kind == "bases" else 0
            bounds, start = np.tile([[0.01, 100.0]], (free, 1)), np.full(free, 1.0 if self.model == "REV" else 2.0)
        if self.gamma > 1:
            bounds, start = np.concatenate([bounds.reshape(-1, 2), [[0.02, 50.0]]]), np.append(start, 0.5)
        return bounds.reshape(-1, 2), start

    def classes(self, x: np.ndarray, freqs: np.ndarray, labels: int) -> list[SiteClass]:
        rates = discrete_gamma(x[-1], self.gamma) if self.gamma > 1 else np.ones(1)
        if self.kind == "codons":
            base = codon_classes(self.model, x, freqs, labels, self.code)
        elif self.kind == "proteins":
            q = (np.ones((20, 20)) if self.exchange is None else np.array(self.exchange, float)) * freqs
            np.fill_diagonal(q, 0)
            np.fill_diagonal(q, -q.sum(1))
            base = [SiteClass(1.0, 1.0, (Model(0, freqs, q / -(freqs @ np.diag(q))),) * labels)]
        elif self.model in ("UNREST", "NH"):
            base = [general_class(self.model, x, labels)]
        else:
            base = [SiteClass(1.0, 1.0, (Model(0, freqs, exchange_matrix(self.model, x[: MODELS[self.model][0]], freqs)),) * labels)]
        return [SiteClass(c.share / len(rates), r, c.processes, c.root) for c in base for r in rates]

    def equal_frequencies(self) -> bool:
        """Whether frequencies aren't taken from the data: they are alike, or parameters of the model."""
        return self.kind == "bases" and (self.model in ("UNREST", "NH") or not MODELS[self.model][1])


def read_tree(text: str) -> tuple[list[Node], list[int]]:
    """(nodes, labels of their branches) of a tree whose tips are numbered like the patterns' taxa."""
    nodes = parse_newick(text)
    return nodes, branch_labels(nodes)

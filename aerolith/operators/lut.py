"""Lookup-table search inside a task: kernels as matrices in leaves of similar candidates, passed by where a norm bound allows it."""

from __future__ import annotations

import numpy as np

LEAF = 64


def _leaves(x: np.ndarray, rows: np.ndarray) -> list[np.ndarray]:
    """Rows in groups of at most LEAF similar ones: halved along the direction between two far rows."""
    out, todo = [], [rows]
    while todo:
        own = todo.pop()
        if len(own) <= LEAF:
            out.append(own)
            continue
        a = x[own[((x[own] - x[own].mean(axis=0)) ** 2).sum(axis=1).argmax()]]
        b = x[own[((x[own] - a) ** 2).sum(axis=1).argmax()]]
        order = np.argsort(x[own] @ (b - a), kind="stable")
        todo += [own[order[: len(own) // 2]], own[order[len(own) // 2 :]]]
    return out


class Table:
    """Kernels of candidates: kernels (candidate, channel, bin), 0 where missing; has (candidate, channel)."""

    def __init__(self, candidates: np.ndarray, kernels: np.ndarray, has: np.ndarray):
        order = np.argsort(candidates, kind="stable")
        self.candidates, self.kernels, self.has = candidates[order], kernels[order], has[order]
        flat = self.kernels.reshape(len(order), -1)
        patterns, kind = np.unique(self.has, axis=0, return_inverse=True)
        self.leaves = [np.sort(leaf) for p in range(len(patterns)) for leaf in _leaves(flat, np.flatnonzero(kind.ravel() == p))]
        self.centres = np.array([self.kernels[leaf].mean(axis=0) for leaf in self.leaves])
        spread = [np.sqrt(((self.kernels[leaf] - c) ** 2).sum(axis=2)).max(axis=0) for leaf, c in zip(self.leaves, self.centres)]
        self.radii, self.own = np.array(spread), np.array([self.has[leaf[0]] for leaf in self.leaves])
        self.met = 0  # pairs of window and candidate that were worked out

    def residuals(self, spectra: np.ndarray, measured: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Mean squared relative deviation over the channels that count, summed in the order of bins and channels."""
        total, count = np.zeros((len(spectra), len(rows))), np.zeros((len(spectra), len(rows)))
        for c in range(measured.shape[1]):
            dot = np.zeros_like(total)
            for b in range(spectra.shape[1]):
                dot += spectra[:, b, None] * self.kernels[rows, c, b]
            m = measured[:, c, None]
            counts = self.has[rows, c] & ~np.isnan(m)
            off = np.where(counts, (dot - m) / m, 0.0)
            total, count = total + off * off, count + counts
        self.met += total.size
        return np.where(count > 0, total / np.where(count > 0, count, 1), np.inf)

    def bounds(self, spectra: np.ndarray, measured: np.ndarray) -> np.ndarray:
        """What no candidate of a leaf can fall below: a kernel's product differs from the centre's by radius times the
        spectrum's norm at most."""
        size = np.sqrt((spectra**2).sum(axis=1))
        total, count = np.zeros((len(spectra), len(self.leaves))), np.zeros((len(spectra), len(self.leaves)))
        for c in range(measured.shape[1]):
            m = measured[:, c, None]
            reach = np.abs(spectra @ self.centres[:, c].T - m) - size[:, None] * self.radii[:, c]
            counts = self.own[:, c] & ~np.isnan(m)
            total = total + np.where(counts, (np.maximum(reach, 0.0) / np.abs(m)) ** 2, 0.0)
            count += counts
        return np.where(count > 0, total / np.where(count > 0, count, 1), np.inf)

    def best(self, spectra: np.ndarray, measured: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Residual and candidate of each window's best candidate (the smaller one on ties); infinite without a usable channel.
        spectra: 0 where missing; measured: NaN where missing or zero."""
        n = self.kernels.shape[2]
        spectra = np.pad(spectra, ((0, 0), (0, max(0, n - spectra.shape[1]))))[:, :n]
        low = self.bounds(spectra, measured)
        finite = np.isfinite(low)
        low[finite] -= 1e-9 * np.abs(low[finite]) + 1e-12  # rounding of the bound
        found, which = np.full(len(spectra), np.inf), np.full(len(spectra), np.iinfo(np.int64).max)
        first = low.argmin(axis=1)

        def visit(leaf: int, rows: np.ndarray) -> None:
            own = self.residuals(spectra[rows], measured[rows], self.leaves[leaf])
            at = own.argmin(axis=1)  # leaves are sorted, so the first is the smallest candidate
            value, candidate = own[np.arange(len(rows)), at], self.candidates[self.leaves[leaf][at]]
            better = (value < found[rows]) | ((value == found[rows]) & (candidate < which[rows]))
            found[rows[better]], which[rows[better]] = value[better], candidate[better]

        for leaf in np.unique(first).tolist():
            visit(leaf, np.flatnonzero(first == leaf))
        for leaf in range(len(self.leaves)):
            rows = np.flatnonzero(finite[:, leaf] & (low[:, leaf] <= found) & (first != leaf))
            if len(rows):
                visit(leaf, rows)
        return found, which

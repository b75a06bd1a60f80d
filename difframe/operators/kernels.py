"""Numeric kernels over one scan: plain numpy, called inside Spark tasks."""

from __future__ import annotations

import numpy as np

#: Instrument defaults: width coefficients, mixing, reach of a line in widths, background terms.
INSTRUMENT = {"u": 0.01, "v": -0.002, "w": 0.005, "eta": 0.5, "cutoff": 10.0, "n_bg": 4}


def local_maxima(y: np.ndarray) -> np.ndarray:
    """Indices of samples higher than both sides; a plateau counts at its middle, the ends never."""
    if len(y) < 3:
        return np.empty(0, int)
    start = np.flatnonzero(np.r_[True, y[1:] != y[:-1]])
    end = np.r_[start[1:], len(y)] - 1
    v = y[start]
    top = np.flatnonzero((v[1:-1] > v[:-2]) & (v[1:-1] > v[2:])) + 1
    return (start[top] + end[top]) // 2


def prominences(y: np.ndarray, peaks: np.ndarray) -> np.ndarray:
    """Height of each peak over the higher of its two cols, which reach to the next higher sample or the end."""
    out = np.empty(len(peaks))
    for i, p in enumerate(peaks):
        left = np.flatnonzero(y[:p] > y[p])
        right = np.flatnonzero(y[p + 1 :] > y[p])
        lo = y[(left[-1] + 1 if len(left) else 0) : p + 1].min()
        hi = y[p : (p + 1 + right[0] if len(right) else len(y))].min()
        out[i] = y[p] - max(lo, hi)
    return out


def thin_out(y: np.ndarray, peaks: np.ndarray, distance: int) -> np.ndarray:
    """Peaks at least ``distance`` samples apart; higher ones stay, of equal ones the later."""
    keep = np.ones(len(peaks), bool)
    for j in np.argsort(y[peaks], kind="stable")[::-1]:
        if keep[j]:
            near = np.abs(peaks - peaks[j]) < distance
            near[j] = False
            keep &= ~near
    return peaks[keep]


def detect_peaks(tth: np.ndarray, iobs: np.ndarray, sigma: np.ndarray, prominence_sigma: float = 5.0, min_distance: float = 0.3) -> np.ndarray:
    """Indices of peaks whose prominence is ``prominence_sigma`` times the median error, ``min_distance`` degrees apart."""
    if len(tth) < 3:
        return np.empty(0, int)
    step = float(tth[1] - tth[0])
    distance = max(1, int(min_distance / step)) if step > 0 else 1
    peaks = thin_out(iobs, local_maxima(iobs), distance)
    return peaks[prominences(iobs, peaks) >= prominence_sigma * float(np.median(sigma))]


def line_profile(tth: np.ndarray, two_theta: np.ndarray, weight: np.ndarray, u: float, v: float, w: float, eta: float, cutoff: float, **_) -> tuple[np.ndarray, int]:
    """Weighted sum of pseudo-Voigt lines over the grid and the number of lines used.

    Lines whose reach lies off the grid, or of no weight, are left out; tails of the others cover the whole grid.
    """
    t = np.tan(np.radians(two_theta / 2))
    fwhm = np.sqrt(np.maximum(u * t * t + v * t + w, 1e-8))
    use = (weight > 0) & (two_theta + cutoff * fwhm >= tth[0]) & (two_theta - cutoff * fwhm <= tth[-1])
    total = np.zeros(len(tth))
    for c, g, a in zip(two_theta[use], fwhm[use], weight[use], strict=True):
        z = (2 * (tth - c) / g) ** 2
        total += a * (eta / (1 + z) + (1 - eta) * np.exp(-np.log(2) * z))
    return total, int(use.sum())


def absolute_weights(two_theta: np.ndarray, multiplicity: np.ndarray, f_sq: np.ndarray, monochromator: float | None = None) -> np.ndarray:
    """Multiplicity x structure factor x Lorentz-polarisation: line weights comparable between phases."""
    t = np.radians(two_theta / 2)
    p = np.cos(2 * t) ** 2
    m = 1.0 if monochromator is None else np.cos(np.radians(monochromator)) ** 2
    lp = (1 + m * p) / (1.0 if monochromator is None else 1 + m) / np.maximum(np.sin(t) ** 2 * np.cos(t), 1e-12)
    return np.where((multiplicity > 0) & (f_sq > 0), multiplicity * f_sq * lp, 0.0)


def _background(tth: np.ndarray, n: int) -> np.ndarray:
    spread = tth.std()
    t = (tth - tth.mean()) / (spread if spread > 0 else 1.0)
    return np.vander(t, n, increasing=True)


def weighted_fit(tth, iobs, sigma, unit, n_bg: int) -> tuple[float, np.ndarray]:
    """Scale and calculated scan of one phase on a polynomial background, by weighted least squares."""
    x = np.column_stack([unit, _background(tth, n_bg)])
    root = 1 / np.sqrt(np.maximum(sigma**2, 1e-10))
    coef = np.linalg.lstsq(x * root[:, None], iobs * root, rcond=None)[0]
    return float(coef[0]), x @ coef


def non_negative(a: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Non-negative least squares by active sets (Lawson and Hanson)."""
    n = a.shape[1]
    x, passive = np.zeros(n), np.zeros(n, bool)
    gram, right = a.T @ a, a.T @ y
    tol = 1e-10 * max(1.0, float(np.abs(right).max(initial=0.0)))
    for _ in range(30 * max(n, 1)):
        slope = right - gram @ x
        slope[passive] = -np.inf
        if passive.all() or slope.max() <= tol:
            break
        passive[int(slope.argmax())] = True
        while True:
            z = np.zeros(n)
            z[passive] = np.linalg.lstsq(gram[np.ix_(passive, passive)], right[passive], rcond=None)[0]
            if not passive.any() or z[passive].min() > 0:
                break
            low = passive & (z <= 0)
            step = float((x[low] / np.maximum(x[low] - z[low], 1e-300)).min())
            x = x + step * (z - x)
            passive &= x > 1e-14
            x[~passive] = 0
        x = z
    return x


def mixture_fit(tth, iobs, sigma, units: list[np.ndarray], n_bg: int) -> tuple[np.ndarray, np.ndarray]:
    """Non-negative scales of several phases on a free background, and the calculated scan.

    The background is projected out first, so only the scales are bounded.
    """
    if not units:
        raise ValueError("no phases to fit")
    root = 1 / np.sqrt(np.maximum(sigma**2, 1e-10))
    bg = _background(tth, n_bg)
    q = np.linalg.qr(bg * root[:, None])[0]
    a = np.column_stack(units) * root[:, None]
    y = iobs * root
    norm = np.maximum(np.linalg.norm(a, axis=0), 1e-300)
    scales = non_negative((a - q @ (q.T @ a)) / norm, y - q @ (q.T @ y)) / norm
    rest = iobs - np.column_stack(units) @ scales
    coef = np.linalg.lstsq(bg * root[:, None], rest * root, rcond=None)[0]
    return scales, np.column_stack(units) @ scales + bg @ coef


def figures(iobs, icalc, sigma, n_params: int) -> dict[str, float]:
    """Rwp, Rp, Rexp and reduced chi-squared of a fit."""
    w = 1 / np.maximum(sigma**2, 1e-10)
    diff = iobs - icalc
    wi = max(float((w * iobs**2).sum()), 1e-20)
    free = max(len(iobs) - n_params, 1)
    chi = float((w * diff**2).sum())
    return {"rwp": (chi / wi) ** 0.5, "rp": float(np.abs(diff).sum() / max(np.abs(iobs).sum(), 1e-20)), "rexp": (free / wi) ** 0.5, "chi2": chi / free}

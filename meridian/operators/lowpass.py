"""Low-pass filters along frequency on modes of few delays, gain errors against them, and narrowband features."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

#: From a median absolute deviation to a standard deviation (a fixed value).
SIGMA = 1.48625


def delay_modes(mhz: np.ndarray, half_width: float | list[float] = 0.2, centre: float | list[float] = 0.0, epsilon: float | list[float] = 1e-12, threshold: float = 1e-12) -> np.ndarray:
    """Leading modes (channels x modes) of signals with delays in one or more bands (microseconds): eigenvectors of
    the sum of sinc covariances, each over its epsilon, whose eigenvalue is `threshold` times the largest or more."""
    apart = mhz[:, None] - mhz[None, :]
    bands = zip(*np.broadcast_arrays(*(np.atleast_1d(np.asarray(x, float)) for x in (centre, half_width, epsilon))))
    signal = sum(np.exp(-2j * np.pi * c * apart) * np.sinc(2 * h * apart) / e for c, h, e in bands)
    value, vector = np.linalg.eigh(signal if np.abs(signal.imag).max(initial=0) > 0 else signal.real)
    value, vector = value[::-1], vector[:, ::-1]
    below = np.flatnonzero(np.abs(value) < threshold * value[0])
    return vector[:, : below[0] if len(below) else len(value)]


def low_pass(modes: np.ndarray, y: np.ndarray, good: np.ndarray) -> np.ndarray:
    """y (channels x series) projected on the modes by its good channels alone, at all channels."""
    normal = modes.conj().T @ (good[:, None] * modes)
    side = modes.conj().T @ (good[:, None] * y)
    return modes @ np.linalg.lstsq(normal, side, rcond=1e-13)[0]


def _median(x: np.ndarray, good: np.ndarray, window: int | None) -> np.ndarray:
    """Median of the good values, of the band or of a window about each channel."""
    x = np.where(good, x, np.nan)
    if window is None:
        return np.full(len(x), np.nanmedian(x) if good.any() else 0.0)
    half = window // 2
    wide = np.pad(x, half, constant_values=np.nan)
    views = np.lib.stride_tricks.sliding_window_view(wide, 2 * half + 1)
    some = ~np.isnan(views).all(axis=1)
    out = np.zeros(len(x))
    out[some] = np.nanmedian(views[some], axis=1)
    return out


def outliers(size: np.ndarray, good: np.ndarray, nsigma: float, most: int, window: int | None = None) -> np.ndarray:
    """The `most` largest good sizes among those over nsigma deviations, the deviation from their median size."""
    sigma = SIGMA * _median(size, good, window)
    above = np.flatnonzero(good & (sigma > 0) & (size > nsigma * sigma))
    return above[np.argsort(-size[above], kind="stable")[:most]]


def _grid(frame: pd.DataFrame, channels: np.ndarray, inputs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Gains and weights as channels x inputs, and each row's place in them."""
    row, column = np.searchsorted(channels, frame["freq_id"]), np.searchsorted(inputs, frame["input_id"])
    gain, weight = np.zeros((len(channels), len(inputs)), complex), np.zeros((len(channels), len(inputs)))
    gain[row, column] = frame["re"].to_numpy() + 1j * frame["im"].to_numpy()
    weight[row, column] = frame["w"].fillna(0).to_numpy()
    return np.nan_to_num(gain), weight, row, column


def _filtered(gain: np.ndarray, modes: np.ndarray, good: np.ndarray, nsigma: float, most: int, rounds: int, window: int | None) -> tuple[np.ndarray, np.ndarray, int]:
    """Smooth gains, the channels left and the number of rounds: until no channel's mean over input pairs of the gain
    over the smooth gain stands out, the channels of the largest are taken out, `most` a round."""
    good = good.copy()
    n = gain.shape[1]
    for turn in range(1, rounds + 1):
        smooth = low_pass(modes, gain, good)
        if turn == rounds:
            break
        ratio = gain * np.divide(1.0, smooth, out=np.zeros_like(smooth), where=smooth != 0)
        upto = np.cumsum(ratio, axis=1)  # sum over pairs i <= j of r_i conj(r_j), without the pairs
        mean = (upto * ratio.conj()).sum(axis=1) / (n * (n + 1) / 2)
        bad = outliers(np.where(good, np.abs(mean - 1), 0.0), good, nsigma, most, window)
        if not len(bad):
            break
        good[bad] = False
    return smooth, good, turn


def gain_error(
    gain: DataFrame, update: list[str], mhz: dict[int, float], half_width: float = 0.2, nsigma: float = 4.0, most: int = 1, rounds: int = 40,
    window: int | None = None, ignored: frozenset[int] = frozenset(), epsilon: float = 1e-12, threshold: float = 1e-12,
) -> DataFrame:
    """update, freq_id, input_id, re, im, w, smooth_re, smooth_im, kept, rounds: gains over their low-pass form.

    gain (update, freq_id, input_id, re, im, w); mhz gives each channel's frequency. The smooth gain is the projection
    on modes of delays within half_width; channels where the mean error over input pairs stands out are left out of
    the fit one by one (nsigma, most, rounds), as are `ignored` channels and those that an input in use has no weight
    in. kept is false for the former; w is the gain's weight times the smooth gain's square where kept, else 0. An
    input without any weight, or an update with no channel left, has zeros.

    The group is one update of the instrument, channels times inputs, however long the table: it is shuffled once and
    all rounds run on it in place, where a round each as a job would shuffle every gain every time."""
    channels = np.array(sorted(mhz), np.int64)
    modes = delay_modes(np.array([mhz[c] for c in channels]), half_width, epsilon=epsilon, threshold=threshold)
    allowed = np.array([c not in ignored for c in channels])

    def solve(frame: pd.DataFrame) -> pd.DataFrame:
        inputs = np.unique(frame["input_id"])
        g, w, row, column = _grid(frame, channels, inputs)
        used = (w > 0).any(axis=0)
        good = allowed & (w[:, used] > 0).all(axis=1) if used.any() else np.zeros(len(channels), bool)
        smooth, kept, turns = np.zeros_like(g), np.zeros(len(channels), bool), 0
        if good.any():
            smooth[:, used], kept, turns = _filtered(g[:, used], modes, good, nsigma, most, rounds, window)
        ratio = g * np.divide(1.0, smooth, out=np.zeros_like(smooth), where=smooth != 0)
        weight = np.where(kept[:, None], w * np.abs(smooth) ** 2, 0.0)
        columns = {"re": ratio.real, "im": ratio.imag, "w": weight, "smooth_re": smooth.real, "smooth_im": smooth.imag}
        out = frame[[*update, "freq_id", "input_id"]].assign(**{k: v[row, column] for k, v in columns.items()})
        return out.assign(kept=kept[row], rounds=turns)

    kinds = ", ".join(f"{c} {gain.schema[c].dataType.simpleString()}" for c in (*update, "freq_id", "input_id"))
    rows = gain.where(gain["freq_id"].isin([int(c) for c in channels])).select(*update, "freq_id", "input_id", "re", "im", "w")
    return rows.groupBy(*update).applyInPandas(solve, f"{kinds}, re double, im double, w double, smooth_re double, smooth_im double, kept boolean, rounds int")


def narrowband_features(
    gain: DataFrame, series: list[str], mhz: dict[int, float], tau_cut: float = 0.6, window: int | None = 151, nsigma: float = 6.0, most: int = 1, rounds: int = 40,
    ignored: frozenset[int] = frozenset(), epsilon: float = 1e-10, threshold: float = 1e-10,
) -> DataFrame:
    """gain with w = 0 where an amplitude stands out from its series' low-pass form (delays under tau_cut): round by
    round the `most` largest residuals over nsigma local deviations go, and the rest is fitted again. A series
    (input and update, one row a channel) without usable channels has no weight at all."""
    channels = np.array(sorted(mhz), np.int64)
    modes = delay_modes(np.array([mhz[c] for c in channels]), tau_cut, epsilon=epsilon, threshold=threshold)
    allowed = np.array([c not in ignored for c in channels])

    def solve(frame: pd.DataFrame) -> pd.DataFrame:
        row = np.searchsorted(channels, frame["freq_id"])
        size, good = np.zeros(len(channels)), np.zeros(len(channels), bool)
        size[row] = np.hypot(frame["re"], frame["im"])
        good[row] = frame["w"].fillna(0).to_numpy() > 0
        good &= allowed & np.isfinite(size)
        usable, size = good.copy(), np.nan_to_num(size)
        for _ in range(rounds if good.any() else 0):
            bad = outliers(np.where(good, np.abs(size - low_pass(modes, size[:, None], good)[:, 0]), 0.0), good, nsigma, most, window)
            if not len(bad):
                break
            good[bad] = False
        flagged = ~good & usable if usable.any() else np.ones(len(channels), bool)
        return frame.assign(w=np.where(flagged[row], 0.0, frame["w"]))

    rows = gain.where(gain["freq_id"].isin([int(c) for c in channels]))
    return rows.groupBy(*series).applyInPandas(solve, gain.schema)

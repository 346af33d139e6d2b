"""Stacked recurrent encoder with fixed random weights, over batches of windows.

Runs inside tasks, on one batch at a time.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BATCH = 512


@dataclass(frozen=True)
class EncoderSpec:
    hidden: int = 64
    layers: int = 2
    seed: int = 42


def layer_weights(spec: EncoderSpec, n_features: int) -> tuple[tuple[np.ndarray, np.ndarray], ...]:
    """Per layer: (input weights, recurrent weights), gates side by side: forget, input, candidate, output."""
    rng = np.random.default_rng(spec.seed)
    layers, width = [], n_features
    for _ in range(spec.layers):
        scale = np.sqrt(2.0 / (width + spec.hidden))
        w = rng.normal(0.0, scale, (width + spec.hidden, 4 * spec.hidden))
        layers.append((w[:width], w[width:]))
        width = spec.hidden
    return tuple(layers)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -500.0, 500.0)))


def _run_layer(drive: np.ndarray, recurrent: np.ndarray, keep_all: bool) -> np.ndarray:
    """`drive` is (steps, batch, 4*hidden): the input part of all gates. Returns hidden states."""
    steps, batch, width = drive.shape
    n = width // 4
    h, c = np.zeros((batch, n)), np.zeros((batch, n))
    kept = np.empty((steps, batch, n)) if keep_all else None
    for t in range(steps):
        z = drive[t] + h @ recurrent
        gates = _sigmoid(z[:, : 2 * n])
        c = gates[:, :n] * c + gates[:, n:] * np.tanh(z[:, 2 * n : 3 * n])
        h = _sigmoid(z[:, 3 * n :]) * np.tanh(c)
        if keep_all:
            kept[t] = h
    return kept if keep_all else h


def encode_driven(drive: np.ndarray, layers: tuple[tuple[np.ndarray, np.ndarray], ...]) -> np.ndarray:
    """Last hidden state of the top layer from the first layer's input part."""
    for i, (_, recurrent) in enumerate(layers):
        top = i == len(layers) - 1
        out = _run_layer(drive, recurrent, keep_all=not top)
        if not top:
            drive = out @ layers[i + 1][0]
    return out


def encode_windows(x: np.ndarray, spec: EncoderSpec, layers: list | None = None) -> np.ndarray:
    """(batch, length, features) -> (batch, hidden); `layers` saves drawing the weights again."""
    layers = layers or layer_weights(spec, x.shape[2])
    return np.concatenate(
        [encode_driven(x[i : i + BATCH].transpose(1, 0, 2) @ layers[0][0], layers) for i in range(0, len(x), BATCH)]
    )

"""Arithmetic of the network on one batch of rows (numpy), forward and backward.

Inputs: embedding vectors (n, slots, 11) and continuous values (n, dense). The ten latent
numbers feed the second-order term and the tower, the eleventh is the linear weight.
"""

from __future__ import annotations

import numpy as np

LATENT = 10


def shapes(slots: int, dense: int, hidden: tuple[int, ...]) -> dict[str, tuple[int, ...]]:
    """Dense parameters in a fixed order; an empty `hidden` leaves the plain FM."""
    out: dict[str, tuple[int, ...]] = {"latent": (dense, LATENT), "linear": (dense,)}
    width = (slots + dense) * LATENT
    for i, size in enumerate([*hidden, 1] if hidden else []):
        out[f"w{i}"], out[f"b{i}"] = (width, size), (size,)
        width = size
    return out


def start(slots: int, dense: int, hidden: tuple[int, ...], seed: int) -> dict[str, np.ndarray]:
    """Uniform start scaled by fan-in and fan-out; biases zero."""
    rng = np.random.default_rng(seed)
    params = {}
    for name, shape in shapes(slots, dense, hidden).items():
        bound = 0.0 if name[0] == "b" else np.sqrt(6.0 / (shape[0] + (shape[1:] or (1,))[0]))
        params[name] = rng.uniform(-1.0, 1.0, shape) * bound
    return params


def flatten(params: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([p.ravel() for p in params.values()])


def unflatten(flat: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, p in like.items():
        out[name] = flat[at : at + p.size].reshape(p.shape)
        at += p.size
    return out


def keep_mask(keys: np.ndarray, width: int, rate: float, seed: int) -> np.ndarray:
    """Dropout mask from a hash of row key and unit: a repeated task draws the same mask."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15)
        x = x + np.arange(width, dtype=np.uint64)[None, :] * np.uint64(0xD1B54A32D192ED03)
        x = x + np.uint64(seed)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        x = x ^ (x >> np.uint64(31))
    return (x >> np.uint64(11)).astype(np.float64) / float(1 << 53) >= rate


def tower_depth(params: dict[str, np.ndarray]) -> int:
    return sum(1 for name in params if name[0] == "w")


def forward(params, emb, dense, dropout=0.0, keys=None, seed=0):
    """Logits and what the backward pass needs."""
    n = len(dense)
    latent = np.concatenate(
        [emb[:, :, :LATENT], dense[:, :, None] * params["latent"][None]], axis=1
    )
    summed = latent.sum(axis=1)
    logit = 0.5 * (summed**2 - (latent**2).sum(axis=1)).sum(axis=1)
    logit += emb[:, :, LATENT].sum(axis=1) + dense @ params["linear"]
    layers = []
    x = latent.reshape(n, -1)
    depth = tower_depth(params)
    for i in range(depth):
        z = x @ params[f"w{i}"] + params[f"b{i}"]
        mask = None
        if i < depth - 1:
            mask = (z > 0).astype(z.dtype)
            if dropout:
                mask *= keep_mask(keys, z.shape[1], dropout, seed * 1000 + i) / (1.0 - dropout)
        layers.append((x, mask))
        x = z if mask is None else z * mask
    if depth:
        logit += x[:, 0]
    return logit, (latent, summed, layers)


def loss_of(logit, label):
    return np.log1p(np.exp(-np.abs(logit))) + np.maximum(logit, 0) - logit * label


def sigmoid(logit):
    return 0.5 * (1.0 + np.tanh(0.5 * logit))


def backward(params, emb, dense, label, logit, state):
    """Gradients of the summed loss: dense parameters, and embedding vectors per row."""
    latent, summed, layers = state
    n, slots = emb.shape[:2]
    d_logit = sigmoid(logit) - label
    grads = {}
    d_latent = d_logit[:, None, None] * (summed[:, None, :] - latent)
    if layers:
        d = d_logit[:, None]
        for i in range(len(layers) - 1, -1, -1):
            x, mask = layers[i]
            if mask is not None:
                d = d * mask
            grads[f"w{i}"], grads[f"b{i}"] = x.T @ d, d.sum(axis=0)
            d = d @ params[f"w{i}"].T
        d_latent = d_latent + d.reshape(latent.shape)
    grads["latent"] = np.einsum("nik,ni->ik", d_latent[:, slots:], dense)
    grads["linear"] = dense.T @ d_logit
    d_emb = np.empty_like(emb)
    d_emb[:, :, :LATENT] = d_latent[:, :slots]
    d_emb[:, :, LATENT] = d_logit[:, None]
    return {name: grads[name] for name in params}, d_emb


def matrix(column, width):
    """A list column of fixed width from an Arrow batch, as a matrix of doubles."""
    return np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), width)

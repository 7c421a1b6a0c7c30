"""The numbers behind example charts: similarity maps, token strengths, overlays. Drawing is left to others."""

from __future__ import annotations

import textwrap

import numpy as np

from prismarq.functions.dense import resize

# Leading register tokens, how much stronger they are, how many tokens there must be to tell, clip percentiles.
REGISTERS, STRONGER, TELLING, PERCENTILES = 4, 1.4, 8, (2, 98)
#: Grey of what is not foreground.
BACKGROUND = 30


def has_registers(patches: np.ndarray) -> bool:
    """Whether the first tokens are registers, by their norms."""
    norms = np.linalg.norm(patches, axis=1)
    return len(patches) > TELLING and bool(norms[:REGISTERS].mean() > STRONGER * norms[REGISTERS:].mean())


def square_grid(values: np.ndarray) -> np.ndarray:
    """Values row by row in the smallest square that holds them, zeros at its end."""
    side = int(np.ceil(np.sqrt(len(values))))
    out = np.zeros(side * side)
    out[: len(values)] = values
    return out.reshape(side, side)


def percentile_unit(grid: np.ndarray, eps: float = 1e-8) -> np.ndarray:
    """A grid between two percentiles of its own, as [0, 1]."""
    low, high = np.percentile(grid, PERCENTILES)
    return np.clip((grid - low) / (high - low + eps), 0, 1)


def upsample(grid: np.ndarray, height: int, width: int) -> np.ndarray:
    """Every cell as a block; where blocks do not fill (height, width), the nearest cell's value."""
    rows, cols = height // grid.shape[0], width // grid.shape[1]
    if rows and cols and (rows * grid.shape[0], cols * grid.shape[1]) == (height, width):
        return np.kron(grid, np.ones((rows, cols)))
    blocks = (max(1, rows) * grid.shape[0], max(1, cols) * grid.shape[1])
    at = [((np.arange(n) + 0.5) * b / n).astype(int) // (b // g) for n, b, g in zip((height, width), blocks, grid.shape, strict=True)]
    return grid[np.ix_(*at)]


def similarity_map(cls: np.ndarray, patches: np.ndarray, height: int, width: int, eps: float = 1e-8) -> np.ndarray:
    """(height, width) map in [0, 1] of how alike the class token and each patch are, registers left out."""
    if has_registers(patches):
        patches = patches[REGISTERS:]
    unit = patches / (np.linalg.norm(patches, axis=1, keepdims=True) + eps)
    alike = unit @ (cls / (np.linalg.norm(cls) + eps))
    return upsample(percentile_unit(square_grid(alike)), height, width)


def token_chart(mask: np.ndarray, caption: str, hidden: np.ndarray | None = None, preview: int = 120, eps: float = 1e-8) -> dict:
    """``real`` and ``padding`` tokens, ``norms``, ``scaled`` (norms of real tokens as [0, 1]) and the caption's ``preview``."""
    real = int(np.sum(mask))
    out = {"real": real, "padding": len(mask) - real, "preview": caption[:preview] + ("..." if len(caption) > preview else "")}
    if hidden is not None:
        norms = np.linalg.norm(np.asarray(hidden, dtype=np.float32), axis=1)
        some = norms[:real]
        out["norms"] = norms
        out["scaled"] = (some - some.min()) / (some.max() - some.min() + eps) if real else some
    return out


def wrap(text: str, width: int = 80) -> str:
    """Lines of at most ``width`` characters, cut at spaces."""
    return textwrap.fill(text, width)


def class_overlay(image: np.ndarray, classes: np.ndarray, palette: np.ndarray, opacity: float = 0.5) -> np.ndarray:
    """An image blended with the colour of each pixel's class; class 0 and classes without a colour of their own stay unblended or go dark."""
    h, w = image.shape[:2]
    near = lambda n, size: ((np.arange(n) + 0.5) * size / n).astype(int)
    at = classes[np.ix_(near(h, classes.shape[0]), near(w, classes.shape[1]))]
    colours = np.zeros((256, 3), dtype=np.float64)
    colours[1 : len(palette)] = palette[1:]
    out = (image * (1 - opacity) + colours[at] * opacity).astype(np.uint8)
    out[at == 0] = image[at == 0]
    return out


def depth_colours(depth: np.ndarray, ramp: np.ndarray, height: int, width: int, eps: float = 1e-8) -> np.ndarray:
    """(height, width, 3) colours of foreground depth along ``ramp`` (n, 3); background grey."""
    at = resize(depth, height, width)
    inside = at > 0
    out = np.full((height, width, 3), BACKGROUND, dtype=np.uint8)
    if inside.any():
        low, high = at[inside].min(), at[inside].max()
        place = (at[inside] - low) / (high - low + eps) * (len(ramp) - 1)
        out[inside] = np.asarray(ramp)[place.round().astype(int)]
    return out


def normal_colours(normal: np.ndarray, height: int, width: int) -> np.ndarray:
    """(height, width, 3) colours of unit normals, [-1, 1] as [0, 255]; background grey."""
    bytes_ = np.clip((normal.astype(np.float32) + 1) / 2 * 255, 0, 255).astype(np.uint8)
    colours = np.clip(np.round(resize(bytes_.transpose(2, 0, 1), height, width)), 0, 255).astype(np.uint8).transpose(1, 2, 0)
    near = lambda n, size: ((np.arange(n) + 0.5) * size / n).astype(int)
    inside = np.any(normal != 0, axis=-1)[np.ix_(near(height, normal.shape[0]), near(width, normal.shape[1]))]
    return np.where(inside[..., None], colours, np.uint8(BACKGROUND))

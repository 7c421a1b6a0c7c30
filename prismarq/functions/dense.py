"""Per-image tensor work of the enrichment passes, in NumPy (called from Arrow batches)."""

from __future__ import annotations

import numpy as np

# Fixed values of the dense models' input.
MODEL_HEIGHT, MODEL_WIDTH = 1024, 768
MODEL_MEAN, MODEL_STD = (123.5, 116.5, 103.5), (58.5, 57.0, 57.5)
# Fixed values of the keypoint crop's input.
CROP_MEAN, CROP_STD = (123.675, 116.28, 103.53), (58.395, 57.12, 57.375)
PAD_VALUE = 114


def resize(x: np.ndarray, height: int, width: int) -> np.ndarray:
    """Bilinear resize of (..., H, W) with half-pixel centres and clamped edges."""
    h, w = x.shape[-2:]
    if (h, w) == (height, width):
        return x.astype(np.float32)
    x = x.astype(np.float32)

    def taps(n: int, out: int):
        at = np.clip((np.arange(out) + 0.5) * n / out - 0.5, 0, n - 1)
        low = np.floor(at).astype(int)
        return low, np.minimum(low + 1, n - 1), (at - low).astype(np.float32)

    a, b, t = taps(h, height)
    rows = x[..., a, :] * (1 - t)[:, None] + x[..., b, :] * t[:, None]
    a, b, t = taps(w, width)
    return rows[..., a] * (1 - t) + rows[..., b] * t


def _cubic_weights(n: int, out: int, a: float = -0.5) -> np.ndarray:
    """(out, n) weights of a cubic resize; the kernel widens when it shrinks, so nothing is skipped."""
    scale = max(1.0, n / out)
    centre = (np.arange(out) + 0.5) * n / out
    x = np.abs((np.arange(n) + 0.5 - centre[:, None]) / scale)
    near, far = (a + 2) * x**3 - (a + 3) * x**2 + 1, a * (x**3 - 5 * x**2 + 8 * x - 4)
    w = np.where(x < 1, near, np.where(x < 2, far, 0.0))
    return (w / w.sum(axis=1, keepdims=True)).astype(np.float32)


def resize_cubic(x: np.ndarray, height: int, width: int) -> np.ndarray:
    """Antialiased bicubic resize of (..., H, W)."""
    h, w = x.shape[-2:]
    x = x.astype(np.float32)
    if w != width:
        x = x @ _cubic_weights(w, width).T
    return _cubic_weights(h, height) @ x if h != height else x


def cover_crop(image: np.ndarray, width: int, height: int) -> np.ndarray:
    """An (H, W, 3) image resized to cover (width, height), bicubic, and cropped at its centre."""
    h, w = image.shape[:2]
    scale = max(width / w, height / h)
    new_w, new_h = int(np.ceil(w * scale)), int(np.ceil(h * scale))
    left, top = max(0, (new_w - width) // 2), max(0, (new_h - height) // 2)
    big = resize_cubic(image.transpose(2, 0, 1), new_h, new_w)[:, top : top + height, left : left + width]
    return np.clip(np.round(big), 0, 255).astype(np.uint8).transpose(1, 2, 0)


def pixels(image: np.ndarray) -> np.ndarray:
    """(3, H, W) half floats in [0, 1]."""
    return (image.astype(np.float32) / 255.0).transpose(2, 0, 1).astype(np.float16)


def model_input(image: np.ndarray) -> np.ndarray:
    """(1, 3, 1024, 768) normalised input of the dense models."""
    x = resize(image.transpose(2, 0, 1), MODEL_HEIGHT, MODEL_WIDTH)
    mean, std = (np.array(v, dtype=np.float32)[:, None, None] for v in (MODEL_MEAN, MODEL_STD))
    return ((x - mean) / std)[None]


def unpad(x: np.ndarray, padding: tuple[int, int, int, int]) -> np.ndarray:
    """(..., H, W) without (left, right, top, bottom)."""
    left, right, top, bottom = padding
    return x[..., top : x.shape[-2] - bottom, left : x.shape[-1] - right]


def class_map(logits: np.ndarray, height: int, width: int) -> np.ndarray:
    """(H, W) class of each pixel from (C, h, w) scores."""
    return resize(logits, height, width).argmax(axis=0).astype(np.uint8)


def depth_map(raw: np.ndarray, seg: np.ndarray) -> np.ndarray:
    """Foreground scaled to [0, 1] by its own range; background 0, as is a constant foreground."""
    raw = resize(raw, *seg.shape)
    out, inside = np.zeros(seg.shape, dtype=np.float32), seg > 0
    if inside.any():
        lo, hi = raw[inside].min(), raw[inside].max()
        if hi > lo:
            out[inside] = (raw[inside] - lo) / (hi - lo)
    return out.astype(np.float16)


def normal_map(raw: np.ndarray, seg: np.ndarray, eps: float = 1e-5) -> np.ndarray:
    """(H, W, 3) unit normals from (3, h, w), normalised after the resize; background 0."""
    x = resize(raw, *seg.shape).transpose(1, 2, 0)
    x = x / (np.linalg.norm(x, axis=2, keepdims=True) + eps)
    return (x * (seg > 0)[..., None]).astype(np.float16)


def normal_map_padded(raw: np.ndarray, padding: tuple[int, int, int, int], seg: np.ndarray, floor: float = 1e-8) -> np.ndarray:
    """The same for padded model output, normalised before padding is cut and the map resized."""
    x = raw / np.maximum(np.linalg.norm(raw, axis=0, keepdims=True), floor)
    x = resize(unpad(x, padding), *seg.shape).transpose(1, 2, 0)
    return (x * (seg > 0)[..., None]).astype(np.float16)


def point_map(raw: np.ndarray, scale: float, padding: tuple[int, int, int, int], seg: np.ndarray) -> np.ndarray:
    """(H, W, 3) metric points: model points over the scale, background 0."""
    x = resize(unpad(raw / scale, padding), *seg.shape).transpose(1, 2, 0)
    return (x * (seg > 0)[..., None]).astype(np.float16)


def alpha(raw: np.ndarray, height: int, width: int) -> np.ndarray:
    """(H, W) matte: the fourth channel, resized and clamped to [0, 1]."""
    return np.clip(resize(raw[3], height, width), 0, 1).astype(np.float16)


def unit_keypoints(points: np.ndarray | None, scores: np.ndarray | None, width: int, height: int, n: int = 133) -> np.ndarray:
    """(n, 3) x and y in [-1, 1] with confidence; zeros where nothing was found."""
    if points is None or not len(points):
        return np.zeros((n, 3), dtype=np.float16)
    xy = 2.0 * points / np.array([width, height]) - 1.0
    return np.column_stack([xy, scores]).astype(np.float16)


def letterbox(image: np.ndarray, size: int = 640) -> tuple[np.ndarray, float]:
    """(size, size, 3) image with the original in its corner on grey, and the ratio."""
    h, w = image.shape[:2]
    ratio = min(size / h, size / w)
    out = np.full((size, size, 3), PAD_VALUE, dtype=np.float32)
    small = np.rint(resize(image.transpose(2, 0, 1), int(h * ratio), int(w * ratio))).transpose(1, 2, 0)
    out[: small.shape[0], : small.shape[1]] = small
    return out, ratio


def crop_matrix(centre: np.ndarray, scale: np.ndarray, size: tuple[int, int]) -> np.ndarray:
    """(..., 2, 3) map from crop pixels to image pixels, from the centre, the middle of the upper edge and the corner that completes a right angle."""
    w, h = size
    centre = np.asarray(centre, dtype=np.float64)
    half = -0.5 * np.asarray(scale, dtype=np.float64)[..., 0]
    image = np.stack([centre, centre + np.stack([0 * half, half], axis=-1), centre + np.stack([half, half], axis=-1)], axis=-2)
    crop = np.array([[w / 2, h / 2], [w / 2, h / 2 - w / 2], [0, h / 2 - w / 2]], dtype=np.float64)
    return np.swapaxes(np.linalg.solve(np.column_stack([crop, np.ones(3)]), image), -1, -2)


def warp(image: np.ndarray, matrix: np.ndarray, size: tuple[int, int]) -> np.ndarray:
    """(..., h, w, C) crops sampled bilinearly through (..., 2, 3) ``matrix``; outside is 0."""
    w, h = size
    m = matrix[..., None, None]
    x, y = (m[..., i, 0, :, :] * np.arange(w) + m[..., i, 1, :, :] * np.arange(h)[:, None] + m[..., i, 2, :, :] for i in (0, 1))
    left, top = np.floor(x), np.floor(y)
    fx, fy = x - left, y - top
    left, top = left.astype(np.int64), top.astype(np.int64)
    flat, out = image.reshape(-1, image.shape[2]), np.zeros((*x.shape, image.shape[2]))

    def tap(at: np.ndarray, weight: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Places clamped to the image, and weights that are 0 where they were outside."""
        return np.clip(at, 0, n - 1), weight * ((at >= 0) & (at < n))

    columns = [tap(left + d, fx if d else 1 - fx, image.shape[1]) for d in (0, 1)]
    for yy, wy in (tap(top + d, fy if d else 1 - fy, image.shape[0]) for d in (0, 1)):
        for xx, wx in columns:
            out += (wx * wy)[..., None] * flat.take(yy * image.shape[1] + xx, axis=0)
    return out


def crop_input(image: np.ndarray, centre: np.ndarray, scale: np.ndarray, size: tuple[int, int] = (288, 384)) -> np.ndarray:
    """(..., 3, h, w) normalised input of the keypoint model, one for each of (..., 2) centres and scales."""
    x = warp(image, crop_matrix(centre, scale, size), size)
    x -= CROP_MEAN
    x /= CROP_STD
    return np.moveaxis(x, -1, -3).astype(np.float32, order="C")


def decode_simcc(x: np.ndarray, y: np.ndarray, centre: np.ndarray, scale: np.ndarray, size: tuple[int, int] = (288, 384), ratio: float = 2.0) -> tuple[np.ndarray, np.ndarray]:
    """Keypoints in the image and scores from (K, W*ratio) and (K, H*ratio) score rows."""
    scores = np.minimum(x.max(axis=1), y.max(axis=1))
    at = np.column_stack([x.argmax(axis=1), y.argmax(axis=1)]).astype(np.float64)
    at[scores <= 0] = -1
    return at / ratio / np.array(size) * scale + centre - scale / 2, scores

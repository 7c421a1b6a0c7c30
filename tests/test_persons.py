"""Composed detectors, charts and decoders against plain computations."""

import struct
import zlib

import numpy as np
import pytest

from prismarq.functions import charts, dense
from prismarq.operators import persons
from prismarq.sources import decode
from prismarq.sources.models import plug_in


def grid_output(boxes, ratio, classes=3):
    """Raw detector output (1, cells, 5 + classes) that decodes to ``boxes`` (x1, y1, x2, y2, score, class)."""
    out = np.zeros((1, 6400 + 1600 + 400, 5 + classes), dtype=np.float64)
    for i, (x1, y1, x2, y2, score, cls) in enumerate(boxes):
        cx, cy, w, h = (v * ratio for v in ((x1 + x2) / 2, (y1 + y2) / 2, x2 - x1, y2 - y1))
        cell = 10 * i  # in the first row of the finest grid, stride 8
        out[0, cell, :5] = [cx / 8 - cell % 80, cy / 8 - cell // 80, np.log(w / 8), np.log(h / 8), 1.0]
        out[0, cell, 5 + cls] = score
    return out


IMAGE = np.zeros((320, 480, 3), dtype=np.uint8)
RATIO = min(640 / 320, 640 / 480)
BOXES = [(10, 20, 110, 220, 0.6, 0), (14, 22, 112, 221, 0.9, 0), (200, 30, 300, 300, 0.5, 0), (210, 30, 300, 300, 0.95, 1), (400, 10, 420, 40, 0.2, 0)]


def test_person_boxes():
    seen = []
    found = persons.person_boxes(IMAGE, lambda x: seen.append(x.shape) or grid_output(BOXES, RATIO))
    assert seen == [(1, 3, 640, 640)]
    np.testing.assert_allclose(found, [BOXES[1][:4], BOXES[2][:4]], atol=1e-6)  # overlap, other class and low score are out
    assert len(persons.person_boxes(IMAGE, lambda x: grid_output([], RATIO))) == 0


def test_whole_body():
    size = (288, 384)

    def pose(batch):
        n = len(batch)
        x, y = np.zeros((n, 133, 576)), np.zeros((n, 133, 768))
        x[:, :, 288], y[:, :, 384] = 0.7, 0.8  # the crop's centre
        x[:, 5], y[:, 5] = 0, 0  # not seen
        return x, y

    body = persons.WholeBody(lambda x: grid_output(BOXES, RATIO), pose)
    points, scores, boxes = body.all(IMAGE)
    assert points.shape == (2, 133, 2) and scores.shape == (2, 133) and boxes.shape == (2, 4)
    np.testing.assert_allclose(points[:, 0], (boxes[:, :2] + boxes[:, 2:]) / 2)
    assert (scores[:, 0] == 0.7).all() and (scores[:, 5] == 0).all()
    single, _ = body(IMAGE)
    np.testing.assert_allclose(single[0], [250, 165])  # the largest box
    centre, scale = persons.box_frame(BOXES[0][:4], size)
    assert scale[0] / scale[1] == pytest.approx(0.75) and scale[1] == pytest.approx(250) and centre.tolist() == [60, 120]
    nobody = persons.WholeBody(lambda x: grid_output([], RATIO), pose)
    assert [x.shape for x in nobody.all(IMAGE)] == [(0, 133, 2), (0, 133), (0, 4)] and nobody(IMAGE) == (None, None)
    assert (dense.unit_keypoints(*nobody(IMAGE), 64, 64) == 0).all()


def test_person_pose():
    asked = []

    def pose(image, box):
        asked.append(np.asarray(box).tolist())
        return np.full((308, 2), [10.0, 20.0]), np.ones(308), (40, 40), np.array([100, 50]), np.array([80, 80])

    found = persons.PersonPose(lambda image: ([1, 1, 3, 1], [0.9, 0.8, 0.9, 0.2], [[0, 0, 50, 50], [2, 2, 51, 51], [0, 0, 9, 9], [60, 60, 90, 90]]), pose)
    points, scores = found(IMAGE)
    assert asked == [[0, 0, 50, 50]] and points.shape == (1, 308, 2) and points[0, 0].tolist() == [80, 50] and scores.shape == (1, 308)
    persons.PersonPose(lambda image: ([], [], np.zeros((0, 4))), pose)(IMAGE)
    assert asked[-1] == [0, 0, 479, 319]


def test_similarity_map():
    rng = np.random.default_rng(1)
    cls, patches = rng.normal(size=8), rng.normal(size=(14, 8))
    got = charts.similarity_map(cls, patches, 12, 10)
    cos = [p @ cls / ((np.linalg.norm(p) + 1e-8) * (np.linalg.norm(cls) + 1e-8)) for p in patches] + [0, 0]
    low, high = np.percentile(cos, [2, 98])
    cell = np.clip((np.array(cos) - low) / (high - low + 1e-8), 0, 1).reshape(4, 4)
    assert got.shape == (12, 10)
    np.testing.assert_allclose(got[::3, 0], cell[:, 0])
    np.testing.assert_allclose(charts.upsample(cell, 8, 8)[1::2, 1::2], cell)
    loud = np.concatenate([patches[:4] * 9, patches])
    assert charts.has_registers(loud) and not charts.has_registers(patches) and not charts.has_registers(loud[:8])
    np.testing.assert_allclose(charts.similarity_map(cls, loud, 12, 10), got)


def test_token_chart():
    hidden = np.array([[3.0, 4], [6, 8], [0, 1], [9, 9]])
    chart = charts.token_chart(np.array([1, 1, 1, 0]), "c" * 130, hidden)
    assert (chart["real"], chart["padding"], chart["preview"]) == (3, 1, "c" * 120 + "...")
    np.testing.assert_allclose(chart["scaled"], [4 / 9, 1, 0], atol=1e-6)
    assert charts.wrap("aa bb cc", 5) == "aa bb\ncc" and "norms" not in charts.token_chart(np.zeros(2), "x")


def test_many_crops_in_one_call():
    """Crops inside, across and outside the image, against a pixel-by-pixel computation."""
    rng = np.random.default_rng(5)
    image, size = rng.integers(0, 256, (9, 12, 3)).astype(np.uint8), (6, 8)
    centres, scales = rng.uniform(-8, 18, (7, 2)), rng.uniform(2, 20, (7, 2))
    matrices = dense.crop_matrix(centres, scales, size)
    got = dense.warp(image, matrices, size)
    assert got.shape == (7, 8, 6, 3) and dense.crop_input(image, centres, scales, size).shape == (7, 3, 8, 6)
    at = lambda y, x: image[y, x].astype(float) if 0 <= y < 9 and 0 <= x < 12 else np.zeros(3)
    for n, m in enumerate(matrices):
        np.testing.assert_allclose(m, dense.crop_matrix(centres[n], scales[n], size))
        for v in range(8):
            for u in range(6):
                x, y = m @ [u, v, 1]
                i, j, fx, fy = int(np.floor(x)), int(np.floor(y)), x - np.floor(x), y - np.floor(y)
                want = (1 - fy) * ((1 - fx) * at(j, i) + fx * at(j, i + 1)) + fy * ((1 - fx) * at(j + 1, i) + fx * at(j + 1, i + 1))
                np.testing.assert_allclose(got[n, v, u], want, atol=1e-9)


def test_overlays():
    image = np.full((4, 4, 3), 100, dtype=np.uint8)
    out = charts.class_overlay(image, np.array([[0, 1], [2, 9]], dtype=np.uint8), np.array([[0, 0, 0], [200, 0, 0], [0, 50, 0]]))
    assert out[0, 0].tolist() == [100] * 3 and out[0, 3].tolist() == [150, 50, 50] and out[3, 0].tolist() == [50, 75, 50] and out[3, 3].tolist() == [50, 50, 50]
    ramp = np.stack([np.arange(5)] * 3, axis=1) * 10
    depth = charts.depth_colours(np.array([[0, 1.0], [2, 3]]), ramp, 2, 2)
    assert depth[0, 0].tolist() == [30] * 3 and depth[0, 1].tolist() == [0] * 3 and depth[1, 0].tolist() == [20] * 3 and depth[1, 1].tolist() == [40] * 3
    normal = np.zeros((2, 2, 3))
    normal[0, 1] = [1, 0, -1]
    assert charts.normal_colours(normal, 2, 2)[0].tolist() == [[30] * 3, [255, 127, 0]]


def test_cubic_resize():
    x = np.arange(48, dtype=np.float32).reshape(1, 6, 8)
    np.testing.assert_allclose(dense.resize_cubic(x, 6, 8), x)
    np.testing.assert_allclose(dense.resize_cubic(np.full((1, 9, 5), 7.0), 4, 11), 7.0, rtol=1e-5)
    np.testing.assert_allclose(dense.resize_cubic(x, 3, 4).mean(), x.mean(), rtol=1e-4)
    up = dense.resize_cubic(np.array([[[0, 0, 0, 1, 0, 0, 0]]], dtype=np.float32), 1, 14)[0, 0]
    assert up[6] == pytest.approx(0.8671875) and up[7] == pytest.approx(0.8671875) and up[5] == pytest.approx(0.2265625)


def png(rows, width, depth, colour, palette=b""):
    part = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    head = part(b"IHDR", struct.pack(">IIBBBBB", width, len(rows), depth, colour, 0, 0, 0))
    return b"\x89PNG\r\n\x1a\n" + head + (part(b"PLTE", palette) if palette else b"") + part(b"IDAT", zlib.compress(b"".join(rows))) + part(b"IEND", b"")


def filtered(image):
    """Rows of an RGB image under each of the five filters in turn."""
    rows, above = [], np.zeros(image.shape[1] * 3, dtype=np.int64)
    for y, line in enumerate(image.reshape(len(image), -1).astype(np.int64)):
        left = np.concatenate([np.zeros(3, dtype=np.int64), line[:-3]])
        corner = np.concatenate([np.zeros(3, dtype=np.int64), above[:-3]])
        p = left + above - corner
        paeth = np.where((abs(p - left) <= abs(p - above)) & (abs(p - left) <= abs(p - corner)), left, np.where(abs(p - above) <= abs(p - corner), above, corner))
        guess = [0 * line, left, above, (left + above) // 2, paeth][y % 5]
        rows.append(bytes([y % 5]) + ((line - guess) % 256).astype(np.uint8).tobytes())
        above = line
    return rows


def test_decoders():
    image = np.random.default_rng(3).integers(0, 256, (11, 7, 3), dtype=np.uint8)
    np.testing.assert_array_equal(decode.decode_rgb(png(filtered(image), 7, 8, 2)), image)
    np.testing.assert_array_equal(decode.decode_bgr(png(filtered(image), 7, 8, 2)), image[..., ::-1])
    bits = decode.decode_rgb(png([b"\0\xa0", b"\0\x40"], 3, 1, 0))
    assert bits[..., 0].tolist() == [[255, 0, 255], [0, 255, 0]]
    assert decode.decode_rgb(png([b"\0\x01\x00"], 2, 8, 3, bytes([1, 2, 3, 9, 8, 7]))).tolist() == [[[9, 8, 7], [1, 2, 3]]]
    assert decode.decode_rgb(png([b"\0\x05\xff\x06\x00"], 2, 8, 4)).tolist() == [[[5] * 3, [6] * 3]]
    rows = b"".join(image[y, :, ::-1].tobytes() + b"\0" * 3 for y in range(10, -1, -1))
    bmp = b"BM" + struct.pack("<IHHI", 54 + len(rows), 0, 0, 54) + struct.pack("<IiiHHIIiiII", 40, 7, 11, 1, 24, 0, len(rows), 0, 0, 0, 0) + rows
    np.testing.assert_array_equal(decode.decode_rgb(bmp), image)
    np.testing.assert_array_equal(decode.decode_rgb(b"P6 # made\n7 11\n255\n" + image.tobytes()), image)
    for bad in (None, b"", b"junk", png(filtered(image), 7, 8, 2)[:60], bmp[:80]):
        assert decode.decode_rgb(bad) is None


def test_plug_in_is_loaded_where_it_is_used(tmp_path, monkeypatch):
    (tmp_path / "made_backends.py").write_text("calls = []\ndef factory():\n    calls.append(1)\n    return len, {'caption': str.upper}\n")
    monkeypatch.syspath_prepend(str(tmp_path))
    decoder, backends = plug_in("made_backends:factory")
    import made_backends

    assert made_backends.calls == []
    assert decoder(b"abc") == 3 and backends.get("caption")("x") == "X" and backends.get("seg") is None and made_backends.calls == [1]

"""Person detection and whole-body keypoints: the detector and pose stages composed around injected models.

Models are callables on arrays, so the same composition runs over ONNX sessions,
GPU modules or, in tests, plain functions.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np

from prismarq.functions import dense as D
from prismarq.operators import detection as T

# Class number of persons for each detector, keypoints of each pose model.
PERSON, PERSON_2 = 0, 1
KEYPOINTS, KEYPOINTS_2 = 133, 308
BOX_SCORE_2, BOX_OVERLAP_2 = 0.3, 0.3
PADDING = 1.25


def person_boxes(image: np.ndarray, detector: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """(N, 4) corners of persons in an RGB image, best score first.

    ``detector`` takes a (1, 3, S, S) letterboxed batch and gives (1, cells, 5 + classes):
    centre offsets, log sizes, objectness and class scores.
    """
    boxed, ratio = D.letterbox(image)
    cells = T.decode_grid(np.asarray(detector(boxed.transpose(2, 0, 1)[None].astype(np.float32)))[0])
    centre, half = cells[:, :2], cells[:, 2:4] / 2
    corners = np.concatenate([centre - half, centre + half], axis=1) / ratio
    # Classes are suppressed one by one, so those of other things have no say here.
    scores = cells[:, 4] * cells[:, 5 + PERSON]
    some = np.flatnonzero(scores > T.NMS_SCORE)
    some = some[np.argsort(-scores[some], kind="stable")]
    some = some[T.suppress(*corners[some].T, np.arange(len(some)), T.NMS_THRESHOLD)]
    return corners[some[scores[some] > T.PERSON_SCORE]]


def person_boxes_2(image: np.ndarray, detector: Callable[[np.ndarray], tuple]) -> np.ndarray:
    """(N, 4) corners of persons; the whole image if there is none.

    ``detector`` takes the RGB image and gives (labels, scores, corners) of everything it finds.
    """
    labels, scores, corners = (np.asarray(x) for x in detector(image))
    some = np.flatnonzero((labels == PERSON_2) & (scores > BOX_SCORE_2))
    if not len(some):
        h, w = image.shape[:2]
        return np.array([[0, 0, w - 1, h - 1]], dtype=np.float32)
    if len(some) == 1:
        return corners[some]
    some = some[np.argsort(-scores[some], kind="stable")]
    return corners[some[T.suppress(*corners[some].T, np.arange(len(some)), BOX_OVERLAP_2)]]


def box_frame(box: np.ndarray, size: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Centre of a corner box, and its padded size grown to the shape of ``size`` (w, h)."""
    box = np.asarray(box, dtype=np.float64)
    w, h = (box[2:] - box[:2]) * PADDING
    shape = size[0] / size[1]
    grown = (w, w / shape) if w > h * shape else (h * shape, h)
    return (box[:2] + box[2:]) / 2, np.array(grown)


def to_image(points: np.ndarray, size, scale, centre) -> np.ndarray:
    """Keypoints in crop pixels as keypoints in the image."""
    return points / np.asarray(size, dtype=np.float64) * np.asarray(scale) + np.asarray(centre) - np.asarray(scale) / 2


@dataclass
class WholeBody:
    """Backend of pass ``pose``: persons, a crop for each, and 133 keypoints from two rows of scores per point.

    ``pose`` takes a (N, 3, h, w) batch and gives ((N, K, w * ratio), (N, K, h * ratio)).
    """

    detector: Callable[[np.ndarray], np.ndarray]
    pose: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]
    size: tuple[int, int] = (288, 384)

    def all(self, image: np.ndarray, single: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(N, K, 2) keypoints in the image, (N, K) scores and (N, 4) boxes; with ``single`` of the largest box alone."""
        boxes = person_boxes(image, self.detector)
        if not len(boxes):
            return np.zeros((0, KEYPOINTS, 2)), np.zeros((0, KEYPOINTS)), np.zeros((0, 4))
        if single:
            largest = np.argmax((boxes[:, 2] - boxes[:, 0]) * (boxes[:, 3] - boxes[:, 1]))
            boxes = boxes[largest : largest + 1]
        frames = [box_frame(b, self.size) for b in boxes]
        x, y = self.pose(np.stack([D.crop_input(image, c, s, self.size) for c, s in frames]))
        found = [D.decode_simcc(np.asarray(x[i]), np.asarray(y[i]), c, s, self.size) for i, (c, s) in enumerate(frames)]
        return np.stack([p for p, _ in found]), np.stack([s for _, s in found]), boxes

    def __call__(self, image: np.ndarray) -> tuple[np.ndarray | None, np.ndarray | None]:
        points, scores, _ = self.all(image, single=True)
        return (points[0], scores[0]) if len(points) else (None, None)


@dataclass
class PersonPose:
    """Backend of pass ``pose2``: persons of the whole image, and 308 keypoints of each one's crop.

    ``pose`` takes (image, box) and gives (points, scores, size, centre, scale): keypoints in a
    crop of ``size`` pixels, which shows ``scale`` pixels of the image around ``centre``.
    """

    detector: Callable[[np.ndarray], tuple]
    pose: Callable[[np.ndarray, np.ndarray], tuple]

    def __call__(self, image: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        points, scores = [], []
        for box in person_boxes_2(image, self.detector):
            p, s, size, centre, scale = self.pose(image, box)
            points.append(to_image(np.asarray(p), size, scale, centre))
            scores.append(np.asarray(s))
        if not points:
            return np.zeros((0, KEYPOINTS_2, 2)), np.zeros((0, KEYPOINTS_2))
        return np.stack(points), np.stack(scores)

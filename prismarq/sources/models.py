"""Where backends come from: caption servers, checkpoints, devices, plug-ins. No model is bundled."""

from __future__ import annotations

import base64
import importlib
import json
import os
import urllib.request
from collections.abc import Callable, Mapping
from dataclasses import dataclass

# Fixed values of the caption request.
TEMPERATURE, TIMEOUT = 0.7, 120.0
PROMPT = "Describe this image in one detailed paragraph."


class HttpCaptions:
    """Caption backend that posts an encoded image to a model server; use as the ``caption`` backend.

    ``encode`` turns an RGB array into JPEG bytes; ``send`` posts (url, body, timeout) and gives the reply's bytes.
    """

    def __init__(self, url: str, model: str, encode: Callable, prompt: str = PROMPT, send: Callable[[str, bytes, float], bytes] | None = None):
        self.url, self.model, self.encode, self.prompt, self.send = url.rstrip("/"), model, encode, prompt, send or _post

    def request(self, image, max_tokens: int) -> dict:
        return {
            "model": self.model, "prompt": self.prompt, "images": [base64.b64encode(self.encode(image)).decode("ascii")], "stream": False,
            "options": {"temperature": TEMPERATURE, "num_predict": max_tokens},
        }

    def __call__(self, image, max_tokens: int = 500) -> str:
        reply = self.send(f"{self.url}/api/generate", json.dumps(self.request(image, max_tokens)).encode(), TIMEOUT)
        return json.loads(reply).get("response", "")


def _post(url: str, body: bytes, timeout: float) -> bytes:
    call = urllib.request.Request(url, body, {"Content-Type": "application/json"})
    with urllib.request.urlopen(call, timeout=timeout) as reply:
        return reply.read()


def cached_file(name: str, fetch: Callable[[str, str], None], folder: str) -> str:
    """Path of a checkpoint in a cache folder; fetched under a temporary name and renamed if it is not there."""
    final = os.path.join(folder, name)
    if not os.path.exists(final):
        os.makedirs(os.path.dirname(final), exist_ok=True)
        part = f"{final}.{os.getpid()}.part"
        fetch(name, part)
        os.replace(part, final)
    return final


def pick_device(wanted: str = "auto") -> str:
    """``auto`` is cuda where a GPU library says there is one, else cpu."""
    if wanted != "auto":
        return wanted
    try:
        import torch

        return "cuda" if torch.cuda.is_available() else "cpu"
    except ImportError:
        return "cpu"


def config_name(task: str, size: str, names: list[str]) -> str:
    """First, in order, of the configuration names of a task and size; mattes come in one size."""
    size = "1b" if task == "matting" else size
    found = sorted(n for n in names if task in n and f"_{size}" in n)
    if not found:
        raise FileNotFoundError(f"no configuration for {task} in size {size}")
    return found[0]


_LOADED: dict[str, tuple[Callable, Mapping[str, Callable]]] = {}


@dataclass(frozen=True)
class PlugIn:
    """``module:factory`` that gives (decode, backends); called where it is first used, once in each Python worker.

    Only the name travels to the tasks, never a model.
    """

    spec: str

    def load(self) -> tuple[Callable, Mapping[str, Callable]]:
        if self.spec not in _LOADED:
            module, _, name = self.spec.partition(":")
            _LOADED[self.spec] = getattr(importlib.import_module(module), name)()
        return _LOADED[self.spec]

    def __call__(self, content: bytes):
        """Decode an image."""
        return self.load()[0](content)

    def get(self, name: str) -> Callable | None:
        """The backend of a pass."""
        return self.load()[1].get(name)


def plug_in(spec: str) -> tuple[PlugIn, PlugIn]:
    """(decode, backends) of ``module:factory``, to be loaded by the tasks."""
    return PlugIn(spec), PlugIn(spec)

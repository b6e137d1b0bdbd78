"""Language-model work behind one interface, with an offline stub and retries."""

from __future__ import annotations

import json
import random
import re
import time
import urllib.error
import urllib.request
import uuid
from collections.abc import Callable
from pathlib import Path
from typing import Protocol

import numpy as np

from corpusloom.functions import messages
from corpusloom.operators.features import RequestTooLarge
from corpusloom.settings import EMBED_WIDTH


class Namer(Protocol):
    usage: dict[str, int]

    def name_cluster(self, message: str, cluster_id: int) -> dict: ...

    def assign_categories(self, named: list[dict], message: str) -> dict[int, str]: ...

    def judge(self, message: str) -> dict: ...


class StubNamer:
    """Answers without a model."""

    def __init__(self):
        self.usage = {"calls": 0, "input_tokens": 0, "output_tokens": 0}

    def name_cluster(self, message: str, cluster_id: int) -> dict:
        return {"title": f"Cluster {cluster_id}", "description": "Stub description (dry run).", "coherent": True, "coherence_note": ""}

    def assign_categories(self, named: list[dict], message: str) -> dict[int, str]:
        return {n["id"]: "Uncategorized" for n in named}

    def judge(self, message: str) -> dict:
        return {"coherence": 5.0, "distinctness": 5.0, "overall": 5.0, "notes": "dry run"}


def truth(value: object) -> bool:
    """A boolean from JSON, also where a model wrote it as text."""
    return value.strip().lower() not in ("false", "no", "0", "") if isinstance(value, str) else bool(value)


class ChatNamer(StubNamer):
    """Answers of ``send(system, message) -> (text, input tokens, output tokens)``, tried again on
    bad JSON and passing errors with growing pauses; PermissionError and ValueError of ``send`` are final."""

    def __init__(self, send: Callable[[str, str], tuple[str, int, int]], tries: int = 5, pause: Callable[[float], None] = time.sleep):
        super().__init__()
        self.send, self.tries, self.pause = send, tries, pause

    def call(self, system: str, message: str):
        wait, why = 2.0, None
        for _ in range(self.tries):
            try:
                text, read, written = self.send(system, message)
            except (PermissionError, ValueError):
                raise
            except Exception as e:  # noqa: BLE001
                why = e
                wait = min(wait * 2, 60) if re.search("rate|429|overload", str(e).lower()) else wait
            else:
                for k, n in (("calls", 1), ("input_tokens", read), ("output_tokens", written)):
                    self.usage[k] += n
                try:
                    return json.loads(re.sub(r"\A\s*```(?:json)?\s*|\s*```\s*\Z", "", text))
                except json.JSONDecodeError as e:
                    why = e
            self.pause(wait + random.random())
            wait = min(wait * 1.6, 60)
        raise RuntimeError(f"no answer after {self.tries} tries: {why}")

    def name_cluster(self, message: str, cluster_id: int) -> dict:
        said = self.call(messages.NAME_SYSTEM, message)
        text = lambda k, other="": str(said.get(k, other)).strip()
        return {"title": text("title", f"Cluster {cluster_id}"), "description": text("description"), "coherent": truth(said.get("coherent", True)), "coherence_note": text("coherence_note")}

    def assign_categories(self, named: list[dict], message: str) -> dict[int, str]:
        out = {n["id"]: "Other" for n in named}
        for item in self.call(messages.CATEGORY_SYSTEM, message) if named else []:
            try:
                out[int(item["id"])] = str(item["category"]).strip()
            except (KeyError, ValueError, TypeError):
                continue
        return out

    def judge(self, message: str) -> dict:
        said = self.call(messages.JUDGE_SYSTEM, message)
        return {k: float(said.get(k, 0)) for k in ("coherence", "distinctness", "overall")} | {"notes": str(said.get("notes", "")).strip()}


def post(url: str, key: str, body: dict, timeout: float = 120) -> dict:
    """The JSON answer to ``body``. A refused key is a PermissionError, and a request that is too large
    a RequestTooLarge; what else a service says is in the text of the error."""
    head = {"Content-Type": "application/json", "Authorization": f"Bearer {key}"}
    try:
        with urllib.request.urlopen(urllib.request.Request(url, json.dumps(body).encode(), head), timeout=timeout) as answer:
            return json.loads(answer.read())
    except urllib.error.HTTPError as e:
        said = f"{e.code} {e.read().decode(errors='replace')[:500]}"
        if e.code in (401, 403):
            raise PermissionError(said) from None
        if e.code == 413 or "max_tokens_per_request" in said:
            raise RequestTooLarge(said) from None
        raise RuntimeError(said) from None


def http_chat(url: str, key: str, model: str) -> Callable[[str, str], tuple[str, int, int]]:
    """``send`` for ChatNamer over the common JSON protocol of chat completions at ``url``."""

    def send(system: str, message: str) -> tuple[str, int, int]:
        said = post(f"{url}/chat/completions", key, {"model": model, "messages": [{"role": "system", "content": system}, {"role": "user", "content": message}]})
        used = said.get("usage", {})
        return said["choices"][0]["message"]["content"], used.get("prompt_tokens", 0), used.get("completion_tokens", 0)

    return send


class HttpEmbedder:
    """Vectors from a service that speaks the common JSON protocol of embeddings at ``url``; called by workers."""

    def __init__(self, url: str, key: str, model: str, width: int = EMBED_WIDTH, tries: int = 5):
        self.url, self.key, self.model, self.width, self.tries = url, key, model, width, tries

    def embed(self, keys: list[str], texts: list[str]) -> list[np.ndarray]:
        for left in reversed(range(self.tries)):
            try:
                said = post(f"{self.url}/embeddings", self.key, {"model": self.model, "input": texts, "dimensions": self.width})
            except (PermissionError, RequestTooLarge):
                raise
            except (RuntimeError, OSError):
                if not left:
                    raise
                time.sleep(2.0 * (self.tries - left) + random.random())
            else:
                return [np.asarray(x["embedding"], dtype=np.float32) for x in sorted(said["data"], key=lambda x: x["index"])]


class FileTokenizer:
    """A tokenizer from a public vocabulary file; loaded once in each process."""

    def __init__(self, path: str):
        self.path = path

    @property
    def own(self):
        from tokenizers import Tokenizer

        if "_own" not in self.__dict__:
            self._own = Tokenizer.from_file(self.path)
        return self._own

    def __getstate__(self) -> dict:
        return {"path": self.path}

    def encode(self, text: str) -> list[int]:
        return self.own.encode(text, add_special_tokens=False).ids

    def decode(self, ids: list[int]) -> str:
        return self.own.decode(ids)


class FolderQueue:
    """Batches of requests as files of JSON lines in a folder, for any queue that is answered later:
    ``<batch>.requests.jsonl`` holds custom_id, system and message of each, and whoever runs them
    leaves custom_id and answer of each in ``<batch>.answers.jsonl``."""

    def __init__(self, folder: str, system: str = messages.CLEAN_SYSTEM):
        self.folder, self.system = Path(folder), system

    def submit(self, requests: list[tuple[str, str]]) -> str:
        batch = uuid.uuid4().hex
        lines = [json.dumps({"custom_id": i, "system": self.system, "message": m}, ensure_ascii=False) + "\n" for i, m in requests]
        self.folder.mkdir(parents=True, exist_ok=True)
        (self.folder / f"{batch}.part").write_text("".join(lines), encoding="utf-8")
        (self.folder / f"{batch}.part").rename(self.folder / f"{batch}.requests.jsonl")
        return batch

    def results(self, batch_id: str) -> list[tuple[str, str]] | None:
        answers = self.folder / f"{batch_id}.answers.jsonl"
        if not answers.exists():
            return None
        said = [json.loads(line) for line in answers.read_text(encoding="utf-8").split("\n") if line.strip()]
        return [(x["custom_id"], x["answer"]) for x in said]

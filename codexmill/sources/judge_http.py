"""A judge behind an HTTP chat endpoint, and the settings file it reads.

Off by default everywhere; nothing in the package calls it by itself.
"""

from __future__ import annotations

import json
import os
import urllib.error
import urllib.request

from codexmill.operators.classify import JUDGED_TYPES


def load_env(path: str) -> dict[str, str]:
    """``KEY=VALUE`` lines of a file; comments and lines without ``=`` are skipped. Set variables are not replaced."""
    found: dict[str, str] = {}
    if os.path.exists(path):
        with open(path, encoding="utf-8") as f:
            for line in f:
                line = line.strip()
                if line and not line.startswith("#") and "=" in line:
                    key, value = line.split("=", 1)
                    found[key.strip()] = value.strip().strip("'\"")
                    os.environ.setdefault(key.strip(), found[key.strip()])
    return found


def parse_answer(content: str) -> dict | None:
    """The JSON object of an answer, with or without a code fence around it; None if there is none."""
    text = content.strip().strip("`").removeprefix("json").strip()
    try:
        answer = json.loads(text)
    except ValueError:
        return None
    if not isinstance(answer, dict) or answer.get("node_type") not in JUDGED_TYPES:
        return None
    try:
        return {"node_type": answer["node_type"], "number_raw": answer.get("number_raw"), "confidence": float(answer.get("confidence") or 0.0)}
    except (TypeError, ValueError):
        return None


class HttpJudge:
    """Callable ``(before, text, after) -> dict | None``; every failure is None."""

    def __init__(self, url: str, model: str, key: str = "", timeout: float = 60.0):
        self.url, self.model, self.key, self.timeout = url.rstrip("/"), model, key, timeout

    def body(self, before: str, text: str, after: str) -> bytes:
        ask = (
            "Classify the line of a legal document. Answer with one JSON object with the keys node_type, number_raw and confidence. "
            f"node_type is one of {', '.join(JUDGED_TYPES)} or null.\nBefore: {before}\nLine: {text}\nAfter: {after}"
        )
        return json.dumps({"model": self.model, "temperature": 0, "messages": [{"role": "user", "content": ask}]}).encode()

    def __call__(self, before: str, text: str, after: str) -> dict | None:
        headers = {"Content-Type": "application/json"} | ({"Authorization": f"Bearer {self.key}"} if self.key else {})
        request = urllib.request.Request(f"{self.url}/chat/completions", self.body(before, text, after), headers)
        try:
            with urllib.request.urlopen(request, timeout=self.timeout) as response:
                return parse_answer(json.load(response)["choices"][0]["message"]["content"])
        except (urllib.error.URLError, TimeoutError, OSError, ValueError, KeyError, IndexError, TypeError):
            return None

"""A client of a chat service over HTTP.

The key is read on the worker from an environment variable when the client is
made, sent in one header and kept nowhere else.
"""

from __future__ import annotations

import json
import os
import urllib.error
import urllib.request
from collections.abc import Callable

from quern.plans.pipeline import Answer, Client

TIMEOUT = 180.0


def http_client(url: str, model: str, key_variable: str = "", timeout: float = TIMEOUT, **options: object) -> Callable[[], Client]:
    """Makes clients that post ``model``, messages and budget as JSON to ``url``
    and read the first choice of the answer."""

    def make() -> Client:
        headers = {"Content-Type": "application/json"}
        if key_variable:
            headers["Authorization"] = "Bearer " + os.environ[key_variable]

        def ask(messages: list[dict], budget: int) -> Answer:
            body = json.dumps({**options, "model": model, "messages": messages, "max_tokens": budget}).encode()
            try:
                with urllib.request.urlopen(urllib.request.Request(url, body, headers), timeout=timeout) as reply:
                    answer = json.load(reply)
            except urllib.error.HTTPError as e:
                return Answer(e.code)
            choice = answer["choices"][0]
            return Answer(200, choice["message"].get("content"), choice.get("finish_reason") or "stop", answer.get("usage"))

        return ask

    return make

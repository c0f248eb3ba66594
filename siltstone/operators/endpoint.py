"""Models behind an endpoint: where they are, what is asked of them, and a generator for the workers."""

from __future__ import annotations

import json
import re
import urllib.request
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from pathlib import Path

from siltstone.operators.quotas import COHORT_METHOD
from siltstone.operators.sandbox import Sandbox, describe
from siltstone.operators.trace import FORBIDDEN, instrumented

#: Tokens of an answer at most, seconds of a request, and how freely the model answers (fixed values).
ANSWER_TOKENS, SECONDS, TEMPERATURE = 1024, 120.0, 0.2

#: What is asked for a script that runs an instrumented program (fixed values: the wording is part of the data format).
SCRIPT_PROMPT = (
    "Following CodeAlchemy Prompt C12, generate a deterministic bash script with 3-5 "
    "structurally distinct tests for this instrumented Python file, saved as source.py. "
    "Use CLI arguments, stdin, or heredocs; redirect stderr to trace1.txt, trace2.txt, and "
    "so on. Use no packages, network, filesystem inputs, randomness, or interactive input. "
    "Return one ```bash``` block only.\n\nInstrumented code:\n{code}\n\nTrace patterns:\n{patterns}"
)


class NoAccess(RuntimeError):
    """A model that can be reached in no way."""


class UnusableAnswer(ValueError):
    """An answer that was broken off, is empty, or is no answer at all."""


@dataclass(frozen=True)
class ModelSpec:
    name: str
    model_id: str
    source: str
    access: str
    server_path: str
    local_path_env: str
    endpoint_env: str


def load_model_specs(path: str) -> dict[str, ModelSpec]:
    """Specifications by name from a JSON file with an object 'models'; further fields are left out."""
    listed = json.loads(Path(path).read_text(encoding="utf-8"))["models"]
    wanted = [f for f in ModelSpec.__dataclass_fields__ if f != "name"]
    return {name: ModelSpec(name, **{f: entry[f] for f in wanted}) for name, entry in listed.items()}


def reachable_at(spec: ModelSpec, environment: Mapping[str, str]) -> tuple[str, str]:
    """('endpoint', URL), or ('local', folder) where no URL is named and the folder exists; nothing is downloaded."""
    url = environment.get(spec.endpoint_env)
    if url:
        return "endpoint", url
    folder = environment.get(spec.local_path_env)
    if folder and Path(folder).is_dir():
        return "local", folder
    raise NoAccess(f"{spec.name}: neither {spec.endpoint_env} nor an existing folder in {spec.local_path_env}")


@dataclass(frozen=True)
class Ask:
    """One question in the chat protocol, and what its answer has to be like."""

    model_id: str
    text: str
    tokens: int = ANSWER_TOKENS

    def body(self) -> bytes:
        message = {"role": "user", "content": self.text}
        return json.dumps({"model": self.model_id, "messages": [message], "max_tokens": self.tokens, "temperature": TEMPERATURE}).encode()

    @staticmethod
    def answer(body: bytes) -> str:
        try:
            first = json.loads(body)["choices"][0]
            ended, said = first.get("finish_reason"), first["message"].get("content")
        except (ValueError, KeyError, IndexError, TypeError, AttributeError) as e:
            raise UnusableAnswer(f"not a chat completion: {e!r}") from None
        if ended != "stop":
            raise UnusableAnswer(f"the answer ended by {ended!r}, not by itself")
        if not isinstance(said, str) or not said.strip():
            raise UnusableAnswer("the answer has no text")
        return said


def post(url: str, body: bytes, seconds: float) -> bytes:
    """Sends JSON and gives the reply's body; HTTP errors are raised."""
    message = urllib.request.Request(url, data=body, headers={"Content-Type": "application/json"}, method="POST")
    with urllib.request.urlopen(message, timeout=seconds) as reply:
        return reply.read()


@dataclass(frozen=True)
class ChatModel:
    """A model at an endpoint; send is how bytes get there and back."""

    model_id: str
    url: str
    seconds: float = SECONDS
    send: Callable[[str, bytes, float], bytes] = post

    def ask(self, text: str, tokens: int = ANSWER_TOKENS) -> str:
        question = Ask(self.model_id, text, tokens)
        return question.answer(self.send(f"{self.url.rstrip('/')}/chat/completions", question.body(), self.seconds))


_WHOLE_FENCE = re.compile(r"\s*```[^\n]*\n(.*?)\n```\s*", re.DOTALL)


def unwrapped(text: str) -> str:
    """Inside of a text that is one fenced block, else the text as it is."""
    m = _WHOLE_FENCE.fullmatch(text)
    return m.group(1) if m else text


_BASH = re.compile(r"```(?:bash)?\s*(.*?)```", re.DOTALL | re.IGNORECASE)
_FORBIDDEN = re.compile(rf"\b(?:{'|'.join(FORBIDDEN)})\b", re.IGNORECASE)


def script_of(text: str) -> str:
    """The script in an answer; raises where it may not run or does not trace the program."""
    m = _BASH.search(text)
    script = (m.group(1) if m else text).strip()
    if _FORBIDDEN.search(script):
        raise UnusableAnswer("the script uses a forbidden command")
    if not all(word in script for word in ("trace", "source.py")):
        raise UnusableAnswer("the script does not trace source.py")
    return script


@dataclass
class Generator:
    """What generate_batch() asks on a worker: (parent, model, method) -> the changed columns of its record.

    models: by the name they have in the data. A parent brings its question in the column
    question. A trace takes two answers and a run in the sandbox, of Python only.
    """

    models: dict[str, ChatModel]
    sandbox: Sandbox | None = None
    tokens: int = ANSWER_TOKENS
    question: str = field(default="question")

    def __call__(self, parent: dict, model: str, method: str) -> dict:
        chat = self.models[model]
        traced = method == COHORT_METHOD
        if traced and (parent["language"] or "").lower() != "python":
            raise ValueError("traces are made of Python programs only")
        if traced and self.sandbox is None:
            raise RuntimeError("a trace needs a sandbox")
        text = chat.ask(parent[self.question], self.tokens)
        made: dict = {"execution_checked": False, "trace_deterministic": None}
        if method == "swallowcode":
            text = unwrapped(text)
        if traced:
            program = instrumented(text)
            script = script_of(chat.ask(SCRIPT_PROMPT.format(code=program.code, patterns=program.patterns)))
            text = describe(program.code, script, self.sandbox.trace(program.code, script))
            made = {"execution_checked": True, "trace_deterministic": True}
        return made | {"content": text, "mock": False, "model_version": chat.model_id, "token_count": len(text.split())}

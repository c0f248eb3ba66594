"""Running instrumented programs where they can do no harm."""

from __future__ import annotations

import re
import secrets
import subprocess
import tempfile
from abc import ABC, abstractmethod
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from pathlib import Path

from siltstone.operators.trace import EVENTS, RECORD

#: An image that is there already; images are never fetched.
IMAGE = "python:3.12-slim"
_HAS_EVENT = re.compile(f"^TRACE:(?:{'|'.join(EVENTS)}):", re.MULTILINE)


class TraceFailed(RuntimeError):
    """A program that could not be run, left no trace, or traced differently when run again."""


def agreed(outputs: Iterable[str]) -> str:
    """The one trace that all outputs are; stops at the first that has no event or is another one."""
    trace = None
    for n, output in enumerate(outputs, 1):
        if not _HAS_EVENT.search(output):
            raise TraceFailed(f"run {n} left no event")
        if trace is not None and output != trace:
            raise TraceFailed(f"run {n} differs from the ones before")
        trace = output
    if trace is None:
        raise TraceFailed("nothing was run")
    return trace


def describe(code: str, script: str, trace: str) -> str:
    """The record of a program, its script and its trace, as trace.format_trace() has it."""
    return RECORD.format(code=code.rstrip(), script=script.rstrip(), trace=trace.rstrip())


class Sandbox(ABC):
    """Runs an instrumented program several times with one script; gives the trace if all runs agree.

    An implementation must keep the program from the network and from the file system of
    the host, bound its time, memory and processes, and remove what it started.
    """

    def __init__(self, runs: int = 3, timeout_seconds: float = 30):
        if runs < 1 or timeout_seconds <= 0:
            raise ValueError("runs and timeout_seconds must be positive")
        self.runs, self.timeout_seconds = runs, timeout_seconds

    @abstractmethod
    def run_once(self, source: str, script: str) -> str: ...

    def trace(self, source: str, script: str) -> str:
        return agreed(self.run_once(source, script) for _ in range(self.runs))


@dataclass(frozen=True)
class Limits:
    """What a container may use (fixed values)."""

    memory: str = "512m"
    processors: str = "1"
    processes: int = 30
    scratch: str = "64m"

    def options(self) -> list[str]:
        bounds = {"--memory": self.memory, "--cpus": self.processors, "--pids-limit": str(self.processes), "--tmpfs": f"/tmp:rw,nosuid,size={self.scratch}", "--network": "none", "--cap-drop": "ALL", "--security-opt": "no-new-privileges", "--pull": "never"}
        return ["--rm", "--interactive", "--read-only", *[x for pair in bounds.items() for x in pair]]


#: Runs inside: the script among copies of the files, then every trace between its marks.
COLLECT = """
import pathlib, shutil, subprocess, sys
home = pathlib.Path("/tmp/home")
shutil.copytree("/given", home)
ended = subprocess.run(["bash", "run.sh"], cwd=home, stdin=subprocess.DEVNULL, stdout=subprocess.DEVNULL)
if ended.returncode:
    sys.exit(ended.returncode)
for file in sorted(p for p in home.glob("trace*.txt") if p.is_file()):
    print(f"===STDERR:{file.name}:START===")
    sys.stdout.write(file.read_text(errors="replace"))
    print(f"===STDERR:{file.name}:END===")
"""


class ContainerSandbox(Sandbox):
    """A container per run, of an engine that takes docker's options; it is removed whatever happens.

    call: how a command is run (as subprocess.run), so that tests need no engine.
    """

    def __init__(self, runs: int = 3, timeout_seconds: float = 30, image: str = IMAGE, engine: str = "docker", limits: Limits = Limits(), call: Callable[..., subprocess.CompletedProcess] = subprocess.run):
        super().__init__(runs, timeout_seconds)
        self.image, self.engine, self.limits, self.call = image, engine, limits, call

    def run_once(self, source: str, script: str) -> str:
        name = f"trace-{secrets.token_hex(12)}"
        with tempfile.TemporaryDirectory(prefix="trace-") as folder:
            Path(folder, "source.py").write_text(source, encoding="utf-8")
            Path(folder, "run.sh").write_text(script, encoding="utf-8")
            command = [self.engine, "run", "--name", name, *self.limits.options(), "--volume", f"{folder}:/given:ro", self.image, "python", "-"]
            try:
                done = self.call(command, input=COLLECT, capture_output=True, text=True, timeout=self.timeout_seconds)
            except FileNotFoundError:
                raise TraceFailed(f"no container engine {self.engine!r}") from None
            except subprocess.TimeoutExpired:
                raise TraceFailed(f"not done after {self.timeout_seconds} s") from None
            finally:
                self._remove(name)
        if done.returncode:
            raise TraceFailed(f"ended with {done.returncode}: {(done.stderr or '').strip()[-300:]}")
        return done.stdout

    def _remove(self, name: str) -> None:
        """Ends the container itself: when its client is stopped it runs on."""
        try:
            self.call([self.engine, "rm", "--force", name], capture_output=True, timeout=10)
        except (FileNotFoundError, subprocess.TimeoutExpired):
            pass

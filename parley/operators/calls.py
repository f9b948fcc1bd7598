"""Calls of a text model from within a task: threads, trying again, and a limit on calls a second."""

from __future__ import annotations

import random
import threading
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

# A scorer answers (task, messages, max_tokens, temperature) with the reply text, with None when there
# is no reply, or with a tuple of the text and the tokens of prompt and reply. A factory makes one
# scorer per task process, so that a client is opened once.
Scorer = Callable[[str, "list[dict[str, str]]", int, float], "str | tuple[str, int, int] | None"]
ScorerFactory = Callable[[], Scorer]

#: Seconds a call takes, on average, for threads to pay.
HARDLY = 0.0005

#: Text of a reply, why there is none, tokens of the prompt and of the reply.
Answer = tuple["str | None", "str | None", "int | None", "int | None"]


class PassingError(RuntimeError):
    """What a scorer raises when the same call may well succeed later, such as at a rate limit.

    ``wait`` is the number of seconds the service asks for, if it does.
    """

    def __init__(self, message: str = "", wait: float | None = None):
        super().__init__(message)
        self.wait = wait


def is_passing(problem: BaseException) -> bool:
    """Errors worth another try: those a scorer calls passing, time-outs and lost connections."""
    return isinstance(problem, (PassingError, TimeoutError, ConnectionError))


@dataclass(frozen=True)
class Retry:
    """When a failed call is made again, and how many calls a task may make.

    A passing error is followed by another call, after ``first_wait`` seconds, then twice as many, up to
    ``longest_wait``, each lengthened by up to a tenth so that tasks do not all come back at once; or after
    the time the error asks for. After ``attempts`` calls, or an error that is not passing, the call has failed.
    ``calls_per_second`` holds for each task, first and further attempts alike; a cluster makes that
    many times the number of tasks that run at once.
    """

    attempts: int = 3
    first_wait: float = 2.0
    longest_wait: float = 60.0
    calls_per_second: float | None = None
    passing: Callable[[BaseException], bool] = is_passing

    def wait(self, attempt: int, problem: BaseException) -> float:
        """Seconds to wait after the ``attempt``-th call, counted from 1."""
        asked = getattr(problem, "wait", None)
        if asked is not None:
            return max(0.0, float(asked))
        waited = min(self.longest_wait, self.first_wait * 2 ** (attempt - 1))
        return waited * (1 + random.random() / 10)


class Budget:
    """Spreads the calls of a task's threads evenly, so that no second holds more than its share."""

    def __init__(self, calls_per_second: float | None):
        self.gap = 1 / calls_per_second if calls_per_second else 0.0
        self.lock = threading.Lock()
        self.due = 0.0

    def take(self) -> None:
        if not self.gap:
            return
        with self.lock:
            now = time.monotonic()
            at = max(now, self.due)
            self.due = at + self.gap
        time.sleep(at - now)


class Caller:
    """Makes the calls of one task."""

    def __init__(self, scorer: Scorer, in_flight: int, retry: Retry):
        self.scorer, self.retry = scorer, retry
        self.in_flight = max(1, in_flight)
        self.budget = Budget(retry.calls_per_second)

    def ask(self, key: str, messages: list[dict], max_tokens: int, temperature: float) -> Answer:
        """One call, made again while it fails with passing errors; a call that fails is no exception."""
        for attempt in range(1, max(1, self.retry.attempts) + 1):
            self.budget.take()
            try:
                reply = self.scorer(key, messages, max_tokens, temperature)
            except Exception as problem:  # noqa: BLE001 - any client failure is data here
                if attempt < self.retry.attempts and self.retry.passing(problem):
                    time.sleep(self.retry.wait(attempt, problem))
                    continue
                return None, str(problem) or type(problem).__name__, None, None
            return (reply[0], None, reply[1], reply[2]) if isinstance(reply, tuple) else (reply, None, None, None)

    def batches(self, batches: Iterator[list[tuple]]) -> Iterator[list[Answer]]:
        """The answers to each batch of ``ask``'s arguments, in order, with up to ``in_flight`` under way.

        As long as calls hardly wait, threads only cost, so they are made here. The rest of a batch goes to threads; one
        takes a run of calls at a time, eight runs or so for each.
        """
        with ThreadPoolExecutor(self.in_flight) as pool:
            for calls in batches:
                done, begun = [], time.monotonic()
                for call in calls:
                    if time.monotonic() - begun > HARDLY * (len(done) + 1):
                        break
                    done.append(self.ask(*call))
                rest = calls[len(done) :]
                step = max(1, len(rest) // (8 * self.in_flight))
                runs = [rest[at : at + step] for at in range(0, len(rest), step)]
                more = pool.map(lambda run: [self.ask(*call) for call in run], runs)
                yield [*done, *(answer for answers in more for answer in answers)]

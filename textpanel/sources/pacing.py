"""A request budget that tasks share without talking to each other.

Each of n tasks makes a request every n-th turn of the overall rate and begins at a turn of its own, so that all together
never go beyond the rate, whichever of them run at the same time. Repetitions take turns as any other request does.
"""

from __future__ import annotations

import random
import time
from collections.abc import Callable


class Pace:
    def __init__(self, per_second: float | None, tasks: int = 1, task: int = 0, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep, luck: Callable[[float, float], float] = random.uniform):
        self.turn_s = 1 / per_second if per_second else 0.0
        self.tasks, self.clock, self.sleep, self.luck = tasks, clock, sleep, luck
        self.due = clock() + task * self.turn_s

    def turn(self) -> None:
        """Waits until this task may make its next request."""
        wait = self.due - self.clock()
        if wait > 0:
            self.sleep(wait)
        self.due = max(self.due, self.clock()) + self.tasks * self.turn_s

    def hold(self, seconds: float) -> None:
        """No request for so long, as a server asks for or a failure suggests."""
        self.due = max(self.due, self.clock() + seconds)

    def back_off(self, attempt: int, most: float = 60.0) -> None:
        """A random pause of up to 2^attempt seconds more each time."""
        self.hold(self.luck(0, min(most, 2.0**attempt)))

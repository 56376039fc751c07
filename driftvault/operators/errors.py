"""Which failures pass, which are the data's fault, and which end a run."""

from __future__ import annotations

import errno
import random
import time

from driftvault.sources.stores import Refused

#: What object stores say of a key or an object that they will never take.
REFUSALS = ("KeyTooLongError", "EntityTooLarge", "InvalidObjectName")
_FATAL = {errno.ENOENT, errno.EACCES, errno.EPERM, errno.EEXIST}
_UNREADABLE = {errno.ENOENT, errno.EACCES, errno.EPERM, errno.EISDIR}
#: The first and the longest wait before a write is tried again, in seconds; tries before a task gives up.
FIRST_WAIT, LONGEST_WAIT, TRIES = 0.5, 60.0, 8


def chain(error: BaseException | None):
    while error is not None:
        yield error
        error = error.__cause__ or error.__context__


def is_refused(error: BaseException) -> bool:
    """Whether a store refuses for good: trying again is of no use, the record goes to the dead letters."""
    return any(isinstance(e, Refused) or any(r in str(e) for r in REFUSALS) for e in chain(error))


def is_unreadable(error: BaseException) -> bool:
    """Whether a file can never be read."""
    return any(isinstance(e, EOFError) or isinstance(e, OSError) and e.errno in _UNREADABLE for e in chain(error))


def category(error: BaseException) -> str:
    """transient: try again; data: this record; fatal: stop the run."""
    if is_refused(error) or isinstance(error, (UnicodeError, ValueError)):
        return "data"
    return "fatal" if isinstance(error, OSError) and error.errno in _FATAL else "transient"


def wait_before(attempt: int, first: float = FIRST_WAIT, most: float = LONGEST_WAIT) -> float:
    """Seconds before try `attempt` + 1: a random share of a half to the whole of a bound that doubles up to `most`."""
    return min(first * 2.0 ** min(attempt, 16), most) * random.uniform(0.5, 1.0)


def retried(action, tries: int = TRIES, sleep=time.sleep):
    """action(), tried again after failures that may pass; any other failure is raised at once."""
    for attempt in range(tries):
        try:
            return action()
        except OSError as e:
            if category(e) != "transient" or attempt == tries - 1:
                raise
            sleep(wait_before(attempt))

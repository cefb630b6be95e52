"""Physical choices and the batch job: size checks, cache scope, plan text, run().

``run`` and its helpers live in ``callfacts.plans.job``; they are loaded on
first use because the job builds on the operators, which use the size checks.
"""

from callfacts.plans.cache import cached
from callfacts.plans.explain import plan_text
from callfacts.plans.sizing import DEFAULT_BROADCAST_MAX_BYTES, Size, measure, row_bytes

_JOB_NAMES = ("JobResult", "JoinOptions", "enrich_calls", "enrich_chat_messages", "enrich_chats", "run")
_PUBLISHED_NAMES = ("PublishedRun", "run_published")


def __getattr__(name):
    if name in _JOB_NAMES:
        from callfacts.plans import job

        return getattr(job, name)
    if name in _PUBLISHED_NAMES:
        from callfacts.plans import published

        return getattr(published, name)
    raise AttributeError(name)


__all__ = [
    "DEFAULT_BROADCAST_MAX_BYTES",
    "Size",
    "cached",
    "measure",
    "plan_text",
    "row_bytes",
    *_JOB_NAMES,
    *_PUBLISHED_NAMES,
]

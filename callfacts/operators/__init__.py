"""DataFrame operators of the job."""

from callfacts.operators.checks import passing, violation_rows, with_violations
from callfacts.operators.enrich import STRATEGIES, choose_strategy, join_client
from callfacts.operators.normalize import parse_message_times, rewrite_nested, to_utc
from callfacts.operators.shapes import chat_messages, client_calls, client_chats

__all__ = [
    "STRATEGIES",
    "chat_messages",
    "choose_strategy",
    "client_calls",
    "client_chats",
    "join_client",
    "parse_message_times",
    "passing",
    "rewrite_nested",
    "to_utc",
    "violation_rows",
    "with_violations",
]

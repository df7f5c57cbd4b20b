from docferry.streaming.control import (
    ControlSource,
    accepted,
    control_batch,
    control_stream,
    job_ready,
    keep_table,
    latest_per_topic,
    parse_control,
    quarantine,
    retry_messages,
    run_on_messages,
    run_when_all_known,
    run_when_ready,
)

__all__ = [
    "ControlSource",
    "accepted",
    "control_batch",
    "control_stream",
    "job_ready",
    "keep_table",
    "latest_per_topic",
    "parse_control",
    "quarantine",
    "retry_messages",
    "run_on_messages",
    "run_when_all_known",
    "run_when_ready",
]

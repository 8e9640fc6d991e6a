"""The rule table for dotted run-metric names."""

from __future__ import annotations

# Kind, match type, match, metric name, names of the labels after the first one.
# The first label is the sender and takes capture 1; label n takes capture n.
_RULES = [
    # Counters
    ("counter", "regex", r"(.+)\.(.+)_start$", "af_agg_job_start", ("job_name",)),
    ("counter", "regex", r"(.+)\.(.+)_end$", "af_agg_job_end", ("job_name",)),
    ("counter", "regex", r"(.+)\.operator_failures_(.+)$", "af_agg_operator_failures", ("operator_name",)),
    ("counter", "regex", r"(.+)\.operator_successes_(.+)$", "af_agg_operator_successes", ("operator_name",)),
    ("counter", "glob", "*.ti_failures", "af_agg_ti_failures", ()),
    ("counter", "glob", "*.ti_successes", "af_agg_ti_successes", ()),
    ("counter", "glob", "*.zombies_killed", "af_agg_zombies_killed", ()),
    ("counter", "glob", "*.scheduler_heartbeat", "af_agg_scheduler_heartbeat", ()),
    ("counter", "glob", "*.dag_processing.processes", "af_agg_dag_processing_processes", ()),
    ("counter", "glob", "*.scheduler.tasks.killed_externally", "af_agg_scheduler_tasks_killed_externally", ()),
    ("counter", "glob", "*.scheduler.tasks.running", "af_agg_scheduler_tasks_running", ()),
    ("counter", "glob", "*.scheduler.tasks.starving", "af_agg_scheduler_tasks_starving", ()),
    ("counter", "glob", "*.scheduler.orphaned_tasks.cleared", "af_agg_scheduler_orphaned_tasks_cleared", ()),
    ("counter", "glob", "*.scheduler.orphaned_tasks.adopted", "af_agg_scheduler_orphaned_tasks_adopted", ()),
    ("counter", "glob", "*.scheduler.critical_section_busy", "af_agg_scheduler_critical_section_busy", ()),
    ("counter", "glob", "*.sla_email_notification_failure", "af_agg_sla_email_notification_failure", ()),
    ("counter", "glob", "*.ti.start.*.*", "af_agg_ti_start", ("dag_id", "task_id")),
    ("counter", "glob", "*.ti.finish.*.*.*", "af_agg_ti_finish", ("dag_id", "task_id", "state")),
    ("counter", "glob", "*.dag.callback_exceptions", "af_agg_dag_callback_exceptions", ()),
    ("counter", "glob", "*.celery.task_timeout_error", "af_agg_celery_task_timeout_error", ()),
    # Gauges
    ("gauge", "glob", "*.dagbag_size", "af_agg_dagbag_size", ()),
    ("gauge", "glob", "*.dag_processing.import_errors", "af_agg_dag_processing_import_errors", ()),
    ("gauge", "glob", "*.dag_processing.total_parse_time", "af_agg_dag_processing_total_parse_time", ()),
    ("gauge", "glob", "*.dag_processing.last_runtime.*", "af_agg_dag_processing_last_runtime", ("dag_file",)),
    ("gauge", "glob", "*.dag_processing.last_run.seconds_ago.*", "af_agg_dag_processing_last_run_seconds", ("dag_file",)),
    ("gauge", "glob", "*.dag_processing.processor_timeouts", "af_agg_dag_processing_processor_timeouts", ()),
    ("gauge", "glob", "*.executor.open_slots", "af_agg_executor_open_slots", ()),
    ("gauge", "glob", "*.executor.queued_tasks", "af_agg_executor_queued_tasks", ()),
    ("gauge", "glob", "*.executor.running_tasks", "af_agg_executor_running_tasks", ()),
    ("gauge", "glob", "*.pool.open_slots.*", "af_agg_pool_open_slots", ("pool_name",)),
    ("gauge", "glob", "*.pool.queued_slots.*", "af_agg_pool_queued_slots", ("pool_name",)),
    ("gauge", "glob", "*.pool.running_slots.*", "af_agg_pool_running_slots", ("pool_name",)),
    ("gauge", "glob", "*.pool.starving_tasks.*", "af_agg_pool_starving_tasks", ("pool_name",)),
    ("gauge", "glob", "*.smart_sensor_operator.poked_tasks", "af_agg_smart_sensor_operator_poked_tasks", ()),
    ("gauge", "glob", "*.smart_sensor_operator.poked_success", "af_agg_smart_sensor_operator_poked_success", ()),
    ("gauge", "glob", "*.smart_sensor_operator.poked_exception", "af_agg_smart_sensor_operator_poked_exception", ()),
    ("gauge", "glob", "*.smart_sensor_operator.exception_failures", "af_agg_smart_sensor_operator_exception_failures", ()),
    ("gauge", "glob", "*.smart_sensor_operator.infra_failures", "af_agg_smart_sensor_operator_infra_failures", ()),
    # Timers
    ("observer", "glob", "*.dagrun.dependency-check.*", "af_agg_dagrun_dependency_check", ("dag_id",)),
    ("observer", "glob", "*.dag.*.*.duration", "af_agg_dag_task_duration", ("dag_id", "task_id")),
    ("observer", "glob", "*.dag_processing.last_duration.*", "af_agg_dag_processing_duration", ("dag_file",)),
    ("observer", "glob", "*.dagrun.duration.success.*", "af_agg_dagrun_duration_success", ("dag_id",)),
    ("observer", "glob", "*.dagrun.duration.failed.*", "af_agg_dagrun_duration_failed", ("dag_id",)),
    ("observer", "glob", "*.dagrun.schedule_delay.*", "af_agg_dagrun_schedule_delay", ("dag_id",)),
    ("observer", "glob", "*.scheduler.critical_section_duration", "af_agg_scheduler_critical_section_duration", ()),
    ("observer", "glob", "*.dagrun.*.first_task_scheduling_delay", "af_agg_dagrun_first_task_scheduling_delay", ("dag_id",)),
]


def metric_rules(sender: str = "instance") -> list[dict]:
    """The rules, with the sender's label under the name that the deployment gives it."""
    return [
        {
            "kind": kind,
            "match_type": match_type,
            "match": match,
            "name": name,
            "labels": {label: f"${i}" for i, label in enumerate((sender, *labels), 1)},
        }
        for kind, match_type, match, name, labels in _RULES
    ]


METRIC_RULES = metric_rules()

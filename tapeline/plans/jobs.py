"""Scan jobs: a registry of what runs and what it gave, with bounded retention."""

from __future__ import annotations

import contextlib
import threading
import time
import traceback
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TTL_HOURS, MOST_JOBS = 24, 200


def retained(jobs: DataFrame, ttl_hours: int = TTL_HOURS, most: int = MOST_JOBS) -> DataFrame:
    """Of finished jobs (job_id, finished_at) those that stay: within the time to live of the last, the newest first."""
    newest = jobs.groupBy().agg(F.max("finished_at").alias("t")).scalar()
    fresh = jobs.where(F.col("finished_at") >= newest - F.expr(f"interval {ttl_hours} hours"))
    return fresh.orderBy(F.desc("finished_at"), F.desc("job_id")).limit(most)


class NotFound(LookupError):
    """There is no such job."""


@dataclass
class Job:
    kind: str
    request: dict[str, Any]
    id: str = field(default_factory=lambda: uuid.uuid4().hex)
    status: str = "queued"  # then running, then succeeded or failed
    result: Any = None
    error: str | None = None
    created: float = field(default_factory=time.time)
    finished: float | None = None
    progress: dict[str, Any] = field(default_factory=dict)


class Jobs:
    """In the driver's memory; finished jobs go after a day, and the oldest beyond MOST_JOBS."""

    def __init__(self, ttl_hours: float = TTL_HOURS, most: int = MOST_JOBS):
        self.ttl, self.most = ttl_hours * 3600, most
        self.jobs: dict[str, Job] = {}
        self.lock = threading.Lock()

    def clean(self, now: float | None = None) -> None:
        now = time.time() if now is None else now
        with self.lock:
            done = sorted((j for j in self.jobs.values() if j.finished is not None), key=lambda j: j.finished)
            for j in done:
                if now - j.finished > self.ttl or len(self.jobs) > self.most:
                    del self.jobs[j.id]

    def submit(self, kind: str, request: dict[str, Any], work: Callable[[], Any], wait: bool = False, spark: SparkSession | None = None, on_progress: Callable[[dict], None] | None = None) -> Job:
        """Run work, in a thread unless wait. With a session the job's progress counts Spark's tasks while it runs;
        counters in the result become its last progress. on_progress gets each change, and its errors end nothing."""
        self.clean()
        job = Job(kind, request)
        with self.lock:
            self.jobs[job.id] = job

        def tell(progress: dict) -> None:
            if progress != job.progress:
                job.progress = progress
                if on_progress:
                    with contextlib.suppress(Exception):
                        on_progress(progress)

        def watch(ended: threading.Event) -> None:
            tracker = spark.sparkContext.statusTracker()
            while not ended.wait(0.5):
                stages = [s for j in tracker.getJobIdsForGroup(job.id) if (i := tracker.getJobInfo(j)) for k in i.stageIds if (s := tracker.getStageInfo(k))]
                tell({"tasks": sum(s.numTasks for s in stages), "tasks_done": sum(s.numCompletedTasks for s in stages)})

        def run() -> None:
            job.status, ended, watcher = "running", threading.Event(), None
            if spark is not None:
                spark.sparkContext.setJobGroup(job.id, job.kind)
                watcher = threading.Thread(target=watch, args=(ended,), daemon=True)
                watcher.start()
            try:
                job.result = work()
                failure = None
            except Exception as e:
                failure = f"{e}".strip() or traceback.format_exc(limit=1)
            ended.set()
            if watcher is not None:
                watcher.join()
                for name in ("spark.jobGroup.id", "spark.job.description"):
                    spark.sparkContext.setLocalProperty(name, None)
            if failure is None and isinstance(job.result, dict) and "counters" in job.result:
                tell(job.result["counters"])
            job.error, job.status = failure, "failed" if failure else "succeeded"
            job.finished = time.time()

        if wait:
            run()
        else:
            threading.Thread(target=run, daemon=True).start()
        return job

    def get(self, job_id: str) -> Job:
        self.clean()
        if job_id not in self.jobs:
            raise NotFound(f"no job {job_id}")
        return self.jobs[job_id]

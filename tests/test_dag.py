"""The order of tasks, retries, and one run at a time."""

import threading
import time

import pytest

from shelfspark.plans.dag import only_run, run_tasks


def test_tasks_run_side_by_side_once_what_they_need_is_done():
    seen, lock, meet = [], threading.Lock(), threading.Barrier(2, timeout=5)

    def task(name, together=False):
        def run():
            if together:
                meet.wait()  # fails unless both run at once
            with lock:
                seen.append(name)

        return run

    took = run_tasks({"load": task("load"), "a": task("a", True), "b": task("b", True)}, {"load": ("a", "b")}, log=lambda _: None)
    assert seen[-1] == "load" and sorted(seen) == ["a", "b", "load"] and list(took)[-1] == "load"


def test_a_failed_task_is_tried_again_and_then_stops_the_rest():
    tries = {"flaky": 0, "bad": 0, "after": 0}

    def fails(name, times):
        def run():
            tries[name] += 1
            if tries[name] <= times:
                raise OSError(name)

        return run

    run_tasks({"flaky": fails("flaky", 1)}, {}, pause=0.0, log=lambda _: None)
    with pytest.raises(OSError, match="bad"):
        run_tasks({"bad": fails("bad", 9), "after": fails("after", 0)}, {"after": ("bad",)}, pause=0.0, log=lambda _: None)
    assert tries == {"flaky": 2, "bad": 2, "after": 0}
    with pytest.raises(ValueError, match="wait for each other"):
        run_tasks({"x": time.time, "y": time.time}, {"x": ("y",), "y": ("x",)})


def test_one_run_at_a_time(spark, tmp_path):
    with only_run(spark, str(tmp_path)):
        with pytest.raises(RuntimeError, match="another run"):
            with only_run(spark, str(tmp_path)):
                pass
    with only_run(spark, str(tmp_path)):
        pass

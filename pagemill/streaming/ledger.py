"""What becomes of a micro-batch that is run again after a crash.

A stream's checkpoint says which batch comes next, not how far the work on it came. The ledger notes a claim
before the work on a batch and its end after it, each as a file published at one stroke in shared storage:

* ``exactly_once`` works on every batch that has no end. The work must replace what an earlier attempt left
  (the sinks here write under the batch's id), so a batch that died half-way is done again and counts once;
* ``at_most_once`` works only on batches that it claims itself. A batch that died half-way is lost, as a
  message is that was taken from a queue by a worker that died, and nothing is ever done twice. Who reads the
  results takes ``finished`` batches and so sees no half of one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import SparkSession

from pagemill.sources.files import names, path_exists, publish_text

EXACTLY_ONCE = "exactly_once"
AT_MOST_ONCE = "at_most_once"


class Ledger:
    def __init__(self, spark: SparkSession, root: str, delivery: str = EXACTLY_ONCE):
        if delivery not in (EXACTLY_ONCE, AT_MOST_ONCE):
            raise ValueError(f"unknown delivery {delivery!r}")
        self.spark, self.root, self.delivery = spark, root.rstrip("/"), delivery

    def _entry(self, batch_id, state: str) -> str:
        return f"{self.root}/{state}/{batch_id}"

    def done(self, batch_id) -> bool:
        return path_exists(self.spark, self._entry(batch_id, "done"))

    def claim(self, batch_id) -> bool:
        """Note the claim; False where the batch was claimed before."""
        return publish_text(self.spark, self._entry(batch_id, "claimed"), "")

    def run(self, batch_id, work: Callable[[], None]) -> bool:
        """Do ``work`` for a batch if its delivery allows it; whether it was done now."""
        if self.done(batch_id):
            return False
        if not self.claim(batch_id) and self.delivery == AT_MOST_ONCE:
            return False
        work()
        publish_text(self.spark, self._entry(batch_id, "done"), "")
        return True

    def finished(self) -> list[str]:
        """Ids of the batches that were done."""
        return names(self.spark, f"{self.root}/done")

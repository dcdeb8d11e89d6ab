"""U-2: vision models as providers: pictures in, answers out, each distinct picture once."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame

from folio.operators.errors import ERROR

#: Fixed value: failures after which a picture is given up.
ATTEMPTS = 2
ANSWER = f"sha256 string, json string, attempts int, error {ERROR}"


class Vision:
    """What a vision model's client does."""

    name = "vision"

    def start(self) -> None:
        """Load or connect to what all pictures of a task share."""

    def stop(self) -> None:
        """Let go of it."""

    def summarise(self, image: bytes, attempt: int) -> str:
        """The model's answer, as JSON of a summary."""
        raise NotImplementedError


def answered(pictures: DataFrame, client: Vision, attempts: int = ATTEMPTS) -> DataFrame:
    """ANSWER of pictures (sha256, image): a picture that the client fails on is tried again, then given up with an error; the others go on. A picture without bytes is an error at once."""

    def one(sha: str, image: bytes | None) -> tuple:
        if image is None:
            return sha, None, 0, {"class": "FigureSummarizationError", "message": "the picture has no bytes", "context": [("sha256", sha)]}
        for k in range(1, attempts + 1):
            try:
                return sha, client.summarise(image, k), k, None
            except Exception as failed:  # noqa: BLE001  whatever it is, it is this picture's
                last = failed
        return sha, None, attempts, {"class": "FigurePoisonPillError", "message": str(last), "context": [("sha256", sha), ("exception", type(last).__name__), ("model", client.name)]}

    kinds = [pa.string(), pa.string(), pa.int32(), pa.struct([("class", pa.string()), ("message", pa.string()), ("context", pa.map_(pa.string(), pa.string()))])]

    def run(batches):
        client.start()
        try:
            for batch in batches:
                rows = [one(sha.as_py(), image.as_py()) for sha, image in zip(batch.column("sha256"), batch.column("image"), strict=True)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], ["sha256", "json", "attempts", "error"])
        finally:
            client.stop()

    # a call takes seconds, so that pictures are dealt out evenly
    return pictures.select("sha256", "image").repartition("sha256").mapInArrow(run, ANSWER)

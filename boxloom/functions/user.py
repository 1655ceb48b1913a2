"""Where user code plugs in: predictors, box producers."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from boxloom.schemas import PREDICTIONS

FAILURES = T.StructType([*PREDICTIONS.fields, T.StructField("error", T.StringType())])


class Predictor(Protocol):
    """Any model: a version and a function from an image path to (width, height, boxes)."""

    model_version: str

    def predict(self, image_path: str) -> dict: ...


def predict_images(images: DataFrame, factory: Callable[[], Predictor], path: str = "relative_path") -> DataFrame:
    """Run a user model over image rows (image_id, path). The output schema never depends on it.

    The model is built once per task; a failing image gives a row with `error` and no boxes.
    """
    names = [f.name for f in PREDICTIONS["boxes"].dataType.elementType.fields]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = None
        for batch in batches:
            if model is None:
                model = factory()
            rows = []
            for ident, where in zip(batch["image_id"], batch["path"]):
                try:
                    found = model.predict(where)
                    boxes = [{n: box.get(n) for n in names} for box in found.get("boxes", [])]
                    rows.append((str(ident), found["width"], found["height"], model.model_version, boxes, None))
                except Exception as error:  # the failure is data, the run goes on
                    rows.append((str(ident), None, None, model.model_version, [], f"{type(error).__name__}: {error}"))
            out = pd.DataFrame(rows, columns=FAILURES.names)
            yield out.astype({"width": "Int32", "height": "Int32"})

    return images.select("image_id", F.col(path).alias("path")).mapInPandas(run, FAILURES)


@F.udtf(returnType="tile_x: int, tile_y: int, tile_width: int, tile_height: int")
class TileBoxes:
    """Table function form of the tile grid, for lateral joins in SQL."""

    def eval(self, width: int, height: int, size: int, overlap: int):
        step = size - overlap
        for top in self._starts(height, size, step):
            for left in self._starts(width, size, step):
                yield left, top, min(size, width), min(size, height)

    @staticmethod
    def _starts(length: int, size: int, step: int) -> list[int]:
        last = max(length - size, 0)
        return [*range(0, last, step), last]


@F.arrow_udtf(returnType="det_id bigint, tile_x int, tile_y int")
class TileCuts:
    """The tiles that each box of a table reaches: whole Arrow batches of (det_id, x1, y1, x2, y2, width, height) in and out.

    Called as `tile_cuts(TABLE(SELECT ...), size, overlap)`; rows stay where they are, so nothing is shuffled. Boxes without
    area, with a null or in an image without a size reach no tile.
    """

    def eval(self, boxes: pa.RecordBatch, size: pa.Array, overlap: pa.Array):
        size, overlap = size[0].as_py(), overlap[0].as_py()
        number = [boxes.column(i).cast(pa.float64()).to_numpy(zero_copy_only=False) for i in range(1, 7)]
        x1, y1, x2, y2, width, height = number
        usable = np.flatnonzero((x2 > x1) & (y2 > y1) & (width > 0) & (height > 0))
        found = []
        for w, h in np.unique(np.stack([width[usable], height[usable]], 1), axis=0):
            here = usable[(width[usable] == w) & (height[usable] == h)]
            for top in self.starts(int(h), size, size - overlap):
                row = here[(y1[here] < top + size) & (y2[here] > top)]
                for left in self.starts(int(w), size, size - overlap):
                    hit = row[(x1[row] < left + size) & (x2[row] > left)]
                    found.append((hit, np.full(len(hit), left, np.int32), np.full(len(hit), top, np.int32)))
        if found:
            at, left, top = (np.concatenate(x) for x in zip(*found))
            yield pa.table({"det_id": boxes.column(0).take(pa.array(at)).cast(pa.int64()), "tile_x": left, "tile_y": top})

    @staticmethod
    def starts(length: int, size: int, step: int) -> list[int]:
        last = max(length - size, 0)
        return [*range(0, last, step), last]

"""Resource catalogue lookups."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Stored column -> name shown to callers.
RESOURCE_COLUMNS = {
    "id": "id",
    "name": "name",
    "original_name": "originalName",
    "description": "description",
    "open_property": "openProperty",
    "open_condition": "openCondition",
    "deleted": "deleted",
    "created_at": "createdAt",
    "updated_at": "updatedAt",
    "structured": "structured",
}


def list_resources(resources: DataFrame, names: Mapping[str, str] = RESOURCE_COLUMNS) -> DataFrame:
    return resources.select(*[F.col(stored).alias(shown) for stored, shown in names.items()])


def _ids_of_class(mapper: DataFrame, class_id) -> DataFrame:
    return mapper.where(F.col("classify_id") == F.lit(class_id)).select("catalog_id")


def resource_of_class(
    resources: DataFrame,
    mapper: DataFrame,
    class_id,
    names: Mapping[str, str] = RESOURCE_COLUMNS,
) -> DataFrame:
    """The resource a class is mapped to; fails if the class has several."""
    wanted = _ids_of_class(mapper, class_id).scalar()
    return list_resources(resources.where(F.col("id") == wanted), names)


def resources_of_class(
    resources: DataFrame,
    mapper: DataFrame,
    class_id: Column | object,
    names: Mapping[str, str] = RESOURCE_COLUMNS,
) -> DataFrame:
    """All resources a class is mapped to.

    Ids are made distinct before the shuffle, so an id that fills a large part of
    the mapper does not land in one task.
    """
    ids = _ids_of_class(mapper, class_id).distinct().withColumnRenamed("catalog_id", "id")
    return list_resources(resources.join(ids, "id", "left_semi"), names)

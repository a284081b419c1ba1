"""License scan: which license notices does a document carry?

MinHash bands over overlapping windows of a document's text retrieve templates, exact shingle containment verifies
them. Windows have twice the size of the class a template falls into and overlap by half, so a notice that stands
together is whole in one of them. A band is ``ROWS`` minima; ``bands_for`` chooses their number so that a notice with
the threshold's share of its shingles in a window that holds as much of other templates again is missed with
probability 1e-6 at most. See ``containment`` for texts, nulls and ties.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assetlake.llm.containment import THRESHOLD, bands_for, hits, item_shingles, retrieve, verified
from assetlake.llm.decontaminate import size_classes

ROWS = 1
BANDS = bands_for(THRESHOLD / 2, ROWS)

# Wording of public license notices.
TEMPLATES = [
    (1, "Released under the MIT License."),
    (2, "Licensed under the Apache License, Version 2.0."),
    (3, "This work is licensed under the GNU General Public License, version 3."),
    (4, "Licensed under CC BY-NC 4.0."),
    (5, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    (6, "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    (7, "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    (8, "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND"),
    (9, "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    (10, "This is free and unencumbered software released into the public domain."),
]


def templates(spark: SparkSession) -> DataFrame:
    rows = [F.struct(F.lit(i).cast("bigint").alias("item_id"), F.lit(t).alias("text")) for i, t in TEMPLATES]
    return spark.range(1).select(F.inline(F.array(*rows)))


def scan(docs: DataFrame, notices: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Pairs of documents (doc_id, text) and the notices (item_id, text) they carry, with the shared share."""
    shingled = item_shingles(notices)
    found = hits(docs, shingled)
    classes = size_classes(shingled) or [(1, 1)]
    return verified(retrieve(found, shingled, classes, BANDS, ROWS), found, shingled, threshold)

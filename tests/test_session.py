"""The shared folder and its cleaner."""

from __future__ import annotations

import os

from tidemark.session import clear_scratch, settle, shared_folder


def test_scratch_is_deleted_and_can_be_written_again(spark):
    folder = shared_folder(spark).removeprefix("file:")
    assert settle(spark.range(10)).count() == 10 and os.listdir(folder)
    clear_scratch(spark)
    assert os.listdir(folder) == []
    assert settle(spark.range(3)).count() == 3

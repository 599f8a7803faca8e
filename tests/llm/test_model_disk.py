"""What the language model leaves on disk when it has learned."""

import os

from mixloom.llm.pitman_yor import PitmanYor
from mixloom.storage import scratch_dir


def test_one_table_stays_for_the_scores(spark):
    docs = spark.createDataFrame([(n, f"one two word{n % 3} one") for n in range(30)], "doc_id long, text string")
    folder = scratch_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    model = PitmanYor(docs)
    left = {name.rsplit("-", 1)[0] for name in set(os.listdir(folder)) - before if name.startswith("model")}
    assert left == {"model-asked"}
    again = [sorted(map(tuple, model.scores().collect())) for _ in range(2)]
    assert len(again[0]) == 30 and again[0] == again[1]

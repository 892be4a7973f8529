"""Word statistics of the quality classifier: counted over all documents but those held out, labelled or not."""

import zlib

import numpy as np

from cargolume.llm import quality


def is_held_out(k):
    return zlib.crc32(str(k).encode()) % 3 == 1


def plain_vectors(texts):
    """Context vectors by plain loops."""
    at, sign = quality.index_vectors()
    sums = np.zeros((quality.WORDS, quality.DIMENSIONS), np.int64)
    for t in texts:
        rows = [zlib.crc32(w.encode()) & (quality.WORDS - 1) for w in quality.TOKEN.findall(t)]
        for i, x in enumerate(rows):
            for y in rows[max(i - quality.WINDOW, 0):i + quality.WINDOW + 1]:
                np.add.at(sums[x], at[y], sign[y])
    return quality.word_table(sums)


def test_unlabelled_documents_count_and_held_out_ones_do_not(spark):
    rows = [(k, f"fine text number{k % 7} here" if k % 2 else f"buy $$$ cheap{k % 5} now") for k in range(120)]
    rows += [(1000 + k, f"unlabelled words stand beside others{k % 9}") for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(120)], "doc_id long, quality int")
    want = plain_vectors([t for k, t in rows if not is_held_out(k)])
    assert np.allclose(quality.fit(docs, labels).vectors, want, atol=1e-6)
    assert quality.training_rows(docs, labels, 20).count() == 20  # the bound of what the network learns from stays

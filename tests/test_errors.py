from tessera import errors as E


def test_messages_and_fields():
    assert str(E.EmptyDataset()) == "dataset cannot be empty"
    assert str(E.VectorLengthMismatch(left=2, right=1)) == "left vector has length 2 but right vector has length 1"
    assert str(E.RaggedMatrix(row=2, expected=2, actual=1)) == "row 2 has 1 columns but expected 2"
    assert str(E.InsufficientSamples(samples=1)) == "at least two samples are required; received 1"
    assert str(E.InvalidK(k=0, sample_count=2)) == "k=0 is invalid for sample count 2"
    assert str(E.InvalidTolerance(algorithm="KMeans")) == "KMeans tolerance must be finite and non-negative"
    assert str(E.FeatureCountMismatch(expected=2, actual=3)) == "feature count 3 does not match expected 2"
    assert str(E.TargetLengthMismatch(samples=2, targets=1)) == "target length 1 does not match sample count 2"
    assert str(E.ConvergenceFailure(algorithm="KMeans", max_iterations=1)) == "KMeans failed to converge within 1 iterations"
    assert E.NonFiniteInput(1, 2) == E.NonFiniteInput(row=1, column=2)
    assert E.NonFiniteInput(1, 2) != E.NonFiniteInput(2, 1)
    assert isinstance(E.EmptyRow(row=1), E.TesseraError)


def test_scale_conf_grows_with_input():
    from tessera.session import scale_conf

    small, big = scale_conf(1 << 30), scale_conf(100 << 40)
    assert int(small["spark.sql.shuffle.partitions"]) == 200
    assert int(big["spark.sql.shuffle.partitions"]) == (100 << 40) // (256 << 20)
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"

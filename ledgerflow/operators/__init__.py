"""DataFrame -> DataFrame operators. Each works on batch DataFrames; the streaming runners in
``ledgerflow.streaming`` reuse them on micro-batches or as stateful streaming plans."""

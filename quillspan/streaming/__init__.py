"""The stateless part of extraction over a stream of documents."""

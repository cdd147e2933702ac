"""Jobs, the inputs they run on in tests and benchmarks, and the registered queries."""

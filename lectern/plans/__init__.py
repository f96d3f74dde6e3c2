"""Tables, sinks and the jobs that tie the operators together."""

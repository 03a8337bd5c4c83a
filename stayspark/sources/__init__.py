"""Tables, topics, snapshots and generated inputs."""

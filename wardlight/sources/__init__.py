"""Reading raw and stored tables, writing results, and checking the inputs."""

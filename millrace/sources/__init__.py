"""Events from messages, files, memory, generators and the driver's tables."""

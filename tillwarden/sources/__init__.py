"""Where rows come from and go to: messages, Kafka, warehouse tables."""

"""Complete daily tables: trips, observations, volumes, and the model on top of them."""

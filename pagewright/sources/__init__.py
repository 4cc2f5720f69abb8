"""What is read and written: listings, manifests, descriptors, artifacts."""
